"""Reference answers as plain SQL for an independent engine (DuckDB).

The oracle works on the *relational* change feed (no JSON round trip), Spark on
the enveloped records, so the two sides share no code. Surrogate key values are
never compared (the hash is engine-specific); the ``key|lsn`` text it hashes is.
"""

from __future__ import annotations

from .catalog import (
    ARRIVALS,
    MUTATION_BASE_LSN,
    MUTATION_COMMIT_TS,
    DECIMAL_LSN_EVERY,
    DELTA_CENTER,
    EMPTY_CURRENCY_EVERY,
    EUR_EVERY,
    FLAT_AFTER_EVERY,
    LOOKUP_ACCOUNT,
    LOST_EVERY,
    LOST_FROM,
    LOST_RECORDS,
    MISSING_EVERY,
    NO_BALANCE_EVERY,
    NO_CURRENCY_EVERY,
    OTHER_BALANCE_EVERY,
    SNAPSHOT_CUT,
    SPARSE_GAP,
    TEXT_BALANCE_EVERY,
    TEXT_KEY_EVERY,
    TORN_EVERY,
)

# Relational feed (FIXTURES.md section 3) and silver projected from it.
FEED_CTES = """
ev AS (
  SELECT event_id + 1 AS lsn, user_id AS account_id,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         ts, value
  FROM events),
feed AS (
  SELECT account_id, lsn, op, ts, value,
         CASE WHEN lsn % 7 = 0 THEN lsn + 1000000000000000 ELSE lsn END AS off FROM ev
  UNION ALL
  SELECT account_id, lsn, op, ts, value, lsn + 2000000000000000 FROM ev WHERE lsn % 10 = 0
  UNION ALL
  SELECT c_custkey, CAST(0 AS BIGINT), 'r', TIMESTAMP '2023-12-31 00:00:00', c_acctbal, -1 - c_custkey
  FROM customer
  UNION ALL
  SELECT NULL::BIGINT, NULL::BIGINT, NULL, NULL::TIMESTAMP, NULL::DOUBLE, lsn + 4000000000000000
  FROM ev WHERE lsn % 997 = 0),
silver AS (
  SELECT off AS kafka_event_offset,
         CAST(COALESCE(account_id % 3, 0) AS INTEGER) AS kafka_partition,
         op AS operation_code,
         account_id,
         CASE WHEN op <> 'd' THEN value END AS current_balance,
         CASE WHEN op <> 'd' THEN 'USD' END AS currency,
         CASE WHEN op <> 'd' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS transaction_timestamp,
         lsn AS source_commit_lsn,
         CASE op WHEN 'c' THEN 'INSERT' WHEN 'r' THEN 'INSERT' WHEN 'u' THEN 'UPDATE'
                 WHEN 'd' THEN 'DELETE' ELSE 'UNKNOWN' END AS operation_type,
         concat_ws('|', CAST(account_id AS VARCHAR), CAST(lsn AS VARCHAR)) AS key_text,
         CASE WHEN op <> 'd' THEN strftime(ts, '%Y-%m') END AS event_month,
         op IS NULL AS junk,
         ts, value
  FROM feed),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (
             PARTITION BY account_id
             ORDER BY source_commit_lsn DESC NULLS LAST, kafka_event_offset DESC NULLS LAST,
                      kafka_partition DESC NULLS LAST) AS rn
  FROM silver),
latest AS (SELECT * FROM ranked WHERE rn = 1),
gold AS (
  SELECT account_id, current_balance, currency, transaction_timestamp, source_commit_lsn, operation_type
  FROM latest WHERE operation_type <> 'DELETE'),
superseded AS (
  SELECT * FROM silver WHERE key_text NOT IN (SELECT key_text FROM latest)),
retained AS (
  SELECT * FROM silver WHERE key_text IN (SELECT key_text FROM latest))
"""

# Two runs: one over the records before the cut, one over what it left and all later ones.
RUN_CTES = f"""
, early AS (SELECT *, ts IS NOT NULL AND ts < TIMESTAMP '{SNAPSHOT_CUT}' AS is_early FROM silver),
first_latest AS (
  SELECT key_text FROM early WHERE is_early
  QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY source_commit_lsn DESC NULLS LAST,
                             kafka_event_offset DESC NULLS LAST, kafka_partition DESC NULLS LAST) = 1),
second_in AS (SELECT * FROM early WHERE NOT is_early OR key_text IN (SELECT key_text FROM first_latest)),
second_latest AS (
  SELECT key_text FROM second_in
  QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY source_commit_lsn DESC NULLS LAST,
                             kafka_event_offset DESC NULLS LAST, kafka_partition DESC NULLS LAST) = 1),
second_out AS (SELECT * FROM second_in WHERE key_text IN (SELECT key_text FROM second_latest))
"""

# Mutation batch from ``events`` and its sequential judgement, as plain windows.
MUTATION_CTES = """
, req AS (
  SELECT event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action,
         user_id AS account_id,
         CASE WHEN event_id % {NO_BALANCE_EVERY} = 0 THEN NULL ELSE value END AS balance,
         CASE WHEN event_id % {EUR_EVERY} = 0 THEN 'EUR'
              WHEN event_id % {NO_CURRENCY_EVERY} = 0 THEN NULL
              WHEN event_id % {EMPTY_CURRENCY_EVERY} = 0 THEN ''
              ELSE 'USD' END AS currency
  FROM events),
base AS (
  SELECT -1 AS seq, 'seed' AS action, account_id, NULL::DOUBLE AS balance, NULL::VARCHAR AS currency,
         TRUE AS flag, currency AS icur
  FROM gold WHERE account_id IN (SELECT account_id FROM req)
  UNION ALL
  SELECT seq, action, account_id, balance, currency,
         CASE WHEN action = 'insert' AND balance IS NOT NULL THEN TRUE
              WHEN action = 'delete' THEN FALSE END,
         CASE WHEN action = 'insert' AND balance IS NOT NULL
              THEN COALESCE(NULLIF(currency, ''), 'USD') END
  FROM req),
scan AS (
  SELECT *,
         COALESCE(LAST_VALUE(flag IGNORE NULLS) OVER (PARTITION BY account_id ORDER BY seq
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS ex,
         LAST_VALUE(icur IGNORE NULLS) OVER (PARTITION BY account_id ORDER BY seq
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cur_before
  FROM base),
decided AS (
  SELECT seq, account_id, action,
         CASE WHEN action IN ('insert', 'update') AND balance IS NULL THEN 'balance required'
              WHEN action IN ('update', 'delete') AND NOT ex THEN 'not found' END AS reason,
         CASE action WHEN 'insert' THEN (CASE WHEN ex THEN 'u' ELSE 'c' END)
                     WHEN 'update' THEN 'u' ELSE 'd' END AS op,
         CASE WHEN action <> 'delete' THEN balance END AS current_balance,
         CASE action WHEN 'insert' THEN COALESCE(NULLIF(currency, ''), 'USD')
                     WHEN 'update' THEN cur_before END AS currency
  FROM scan WHERE action <> 'seed')
""".format(**dict(NO_BALANCE_EVERY=NO_BALANCE_EVERY, EUR_EVERY=EUR_EVERY,
                  NO_CURRENCY_EVERY=NO_CURRENCY_EVERY, EMPTY_CURRENCY_EVERY=EMPTY_CURRENCY_EVERY))

# Delta fold: segments start at an applied insert (or the current balance).
DELTA_CTES = """
, req2 AS (
  SELECT event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action,
         user_id AS account_id, value
  FROM events),
base2 AS (
  SELECT -1 AS seq, 'seed' AS action, account_id, CAST(current_balance AS DECIMAL(20,2)) AS amount, TRUE AS flag
  FROM gold WHERE account_id IN (SELECT account_id FROM req2)
  UNION ALL
  SELECT seq, action, account_id,
         CAST(CASE action WHEN 'update' THEN value - {DELTA_CENTER} WHEN 'insert' THEN value END AS DECIMAL(20,2)),
         CASE action WHEN 'insert' THEN TRUE WHEN 'delete' THEN FALSE END
  FROM req2),
s1 AS (
  SELECT *, COALESCE(LAST_VALUE(flag IGNORE NULLS) OVER (PARTITION BY account_id ORDER BY seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS ex
  FROM base2),
s2 AS (
  SELECT *, action = 'seed' OR (action = 'insert' AND NOT ex) AS is_set,
         action = 'update' AND ex AS is_add, action = 'delete' AND ex AS is_del
  FROM s1),
s3 AS (
  SELECT *, SUM(CASE WHEN is_set THEN 1 ELSE 0 END) OVER (PARTITION BY account_id ORDER BY seq
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
  FROM s2),
s4 AS (
  SELECT *, SUM(CASE WHEN is_set OR is_add THEN amount ELSE 0 END) OVER (PARTITION BY account_id, seg ORDER BY seq
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bal
  FROM s3)
""".format(DELTA_CENTER=DELTA_CENTER)

GOLD_COLS = "account_id, current_balance, currency, transaction_timestamp, source_commit_lsn, operation_type"


def _with(body: str) -> str:
    return "WITH " + FEED_CTES.strip() + "\n" + body.strip()


ORACLE = {
    "silver_parsed": _with(
        """
        SELECT kafka_event_offset, kafka_partition, operation_code, account_id, current_balance,
               currency, transaction_timestamp, source_commit_lsn, operation_type
        FROM silver"""
    ),
    "surrogate_key_stats": _with(
        """
        SELECT CAST(SUM(copies) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys,
               COUNT(*) FILTER (WHERE copies > 1) AS duplicated_keys, MAX(copies) AS max_copies
        FROM (SELECT key_text, COUNT(*) AS copies FROM silver GROUP BY key_text) k"""
    ),
    "duplicate_keys": _with(
        """
        SELECT MIN(account_id) AS account_id, MIN(source_commit_lsn) AS source_commit_lsn,
               COUNT(*) AS copies
        FROM silver GROUP BY key_text HAVING COUNT(*) > 1"""
    ),
    "event_month_counts": _with(
        """
        SELECT event_month, COUNT(*) AS events FROM silver
        WHERE transaction_timestamp IS NOT NULL GROUP BY event_month"""
    ),
    "event_month_all": _with(
        f"""
        SELECT coalesce(event_month, strftime(TIMESTAMP '{ARRIVALS[0]}', '%Y-%m')) AS event_month, COUNT(*) AS events
        FROM silver GROUP BY 1"""
    ),
    "silver_newest_arrivals": _with(
        f"""
        SELECT kafka_partition, kafka_event_offset, account_id,
               CASE WHEN kafka_event_offset % 2 = 0 THEN TIMESTAMP '{ARRIVALS[0]}' ELSE TIMESTAMP '{ARRIVALS[1]}' END AS ingested_at,
               (SELECT COUNT(*) FROM silver) AS total_events
        FROM silver ORDER BY ingested_at DESC, kafka_partition DESC, kafka_event_offset DESC LIMIT 100"""
    ),
    "gold_current": _with(f"SELECT {GOLD_COLS} FROM gold ORDER BY account_id"),
    "gold_sql": _with(f"SELECT {GOLD_COLS} FROM gold ORDER BY account_id"),
    "gold_lookup": _with(f"SELECT {GOLD_COLS} FROM gold WHERE account_id = {LOOKUP_ACCOUNT}"),
    "latest_changes": _with(f"SELECT {GOLD_COLS} FROM latest"),
    "silver_total": _with("SELECT COUNT(*) AS total_events FROM silver"),
    "event_mix": _with(
        """
        SELECT account_id, operation_type, COUNT(*) AS event_count FROM silver
        GROUP BY account_id, operation_type ORDER BY account_id, operation_type"""
    ),
    "silver_newest": _with(
        """
        SELECT account_id, operation_type, current_balance, currency, transaction_timestamp,
               source_commit_lsn, kafka_event_offset
        FROM silver ORDER BY kafka_partition DESC, kafka_event_offset DESC LIMIT 100"""
    ),
    "superseded_rows": _with(
        """
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type
        FROM superseded"""
    ),
    "retained_rows": _with(
        """
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type
        FROM retained"""
    ),
    "compaction_counts": _with(
        """
        SELECT (SELECT COUNT(*) FROM silver) AS rows_before,
               (SELECT COUNT(*) FROM superseded) AS rows_invalidated,
               (SELECT COUNT(*) FROM retained) AS rows_after"""
    ),
    "gold_after_compaction": _with(
        f"""
        SELECT {GOLD_COLS} FROM (
          SELECT *, ROW_NUMBER() OVER (
                     PARTITION BY account_id
                     ORDER BY source_commit_lsn DESC NULLS LAST, kafka_event_offset DESC NULLS LAST,
                              kafka_partition DESC NULLS LAST) AS rn2
          FROM retained) r
        WHERE rn2 = 1 AND operation_type <> 'DELETE'"""
    ),
    "replay_invariance": _with(
        """
        SELECT (SELECT COUNT(*) FROM silver) AS silver_rows_before,
               2 * (SELECT COUNT(*) FROM silver) AS silver_rows_after,
               (SELECT COUNT(*) FROM gold) AS gold_rows,
               CAST(0 AS BIGINT) AS gold_only_before,
               CAST(0 AS BIGINT) AS gold_only_after"""
    ),
    "source_table": _with(
        """
        SELECT account_id, CAST(value AS DECIMAL(14,2)) AS current_balance, 'USD' AS currency,
               CAST(ts AS TIMESTAMP) AS transaction_timestamp, CAST(ts AS TIMESTAMP) AS updated_at
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id
                                           ORDER BY lsn DESC NULLS LAST, off DESC NULLS LAST) AS rn
              FROM feed WHERE op IS NOT NULL AND account_id IS NOT NULL) f
        WHERE rn = 1 AND op <> 'd'
        ORDER BY account_id"""
    ),
    "source_reconcile": _with(
        """
        , src AS (
          SELECT account_id, CAST(value AS DECIMAL(14,2)) AS b, 'USD' AS c,
                 strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS t, TRUE AS in_s
          FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id
                                             ORDER BY lsn DESC NULLS LAST, off DESC NULLS LAST) AS rn
                FROM feed WHERE op IS NOT NULL AND account_id IS NOT NULL) f
          WHERE rn = 1 AND op <> 'd'),
        g AS (
          SELECT account_id, CAST(current_balance AS DECIMAL(14,2)) AS b, currency AS c,
                 transaction_timestamp AS t, TRUE AS in_g
          FROM gold)
        SELECT status, COUNT(*) AS accounts FROM (
          SELECT CASE WHEN g.in_g IS NULL THEN 'source_only'
                      WHEN src.in_s IS NULL THEN 'gold_only'
                      WHEN src.b IS NOT DISTINCT FROM g.b AND src.c IS NOT DISTINCT FROM g.c
                           AND src.t IS NOT DISTINCT FROM g.t THEN 'match'
                      ELSE 'value_diff' END AS status
          FROM src FULL OUTER JOIN g ON src.account_id IS NOT DISTINCT FROM g.account_id) z
        GROUP BY status"""
    ),
    "source_reconcile_rows": _with(
        """
        , src AS (
          SELECT account_id, CAST(value AS DECIMAL(14,2)) AS b, 'USD' AS c,
                 strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS t, TRUE AS in_s
          FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id
                                             ORDER BY lsn DESC NULLS LAST, off DESC NULLS LAST) AS rn
                FROM feed WHERE op IS NOT NULL AND account_id IS NOT NULL) f
          WHERE rn = 1 AND op <> 'd'),
        g AS (
          SELECT account_id, CAST(current_balance AS DECIMAL(14,2)) AS b, currency AS c,
                 transaction_timestamp AS t, TRUE AS in_g
          FROM gold)
        SELECT COALESCE(src.account_id, g.account_id) AS account_id,
               src.b AS source_balance, g.b AS gold_balance,
               CASE WHEN g.in_g IS NULL THEN 'source_only'
                      WHEN src.in_s IS NULL THEN 'gold_only'
                      WHEN src.b IS NOT DISTINCT FROM g.b AND src.c IS NOT DISTINCT FROM g.c
                           AND src.t IS NOT DISTINCT FROM g.t THEN 'match'
                      ELSE 'value_diff' END AS status
          FROM src FULL OUTER JOIN g ON src.account_id IS NOT DISTINCT FROM g.account_id"""
    ),
    "reconcile_by_digest": _with(
        f"""
        , src AS (
          SELECT account_id, CAST(value AS DECIMAL(14,2)) AS b, 'USD' AS c,
                 strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS t, TRUE AS in_s
          FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id
                                             ORDER BY lsn DESC NULLS LAST, off DESC NULLS LAST) AS rn
                FROM feed WHERE op IS NOT NULL AND account_id IS NOT NULL) f
          WHERE rn = 1 AND op <> 'd'),
        g AS (
          SELECT account_id, CAST(current_balance + CASE WHEN account_id % {OTHER_BALANCE_EVERY} = 0 THEN 1 ELSE 0 END AS DECIMAL(14,2)) AS b,
                 currency AS c, transaction_timestamp AS t, TRUE AS in_g
          FROM gold WHERE COALESCE(account_id, 1) % {MISSING_EVERY} <> 0)
        SELECT COALESCE(src.account_id, g.account_id) AS account_id,
               src.b AS source_balance, g.b AS gold_balance,
               CASE WHEN g.in_g IS NULL THEN 'source_only'
                      WHEN src.in_s IS NULL THEN 'gold_only'
                      WHEN src.b IS NOT DISTINCT FROM g.b AND src.c IS NOT DISTINCT FROM g.c
                           AND src.t IS NOT DISTINCT FROM g.t THEN 'match'
                      ELSE 'value_diff' END AS status
          FROM src FULL OUTER JOIN g ON src.account_id IS NOT DISTINCT FROM g.account_id"""
    ),
    "health_counts": _with(
        """
        SELECT TRUE AS silver_table_exists, (SELECT COUNT(*) FROM silver) AS silver_count,
               (SELECT COUNT(*) FROM gold) AS gold_count"""
    ),
    "gold_decimal": _with(
        """
        SELECT account_id, CAST(current_balance AS DECIMAL(14,2)) AS current_balance, currency,
               transaction_timestamp, source_commit_lsn, operation_type
        FROM gold"""
    ),
    "stream_vs_batch": _with(
        """
        SELECT kafka_event_offset, kafka_partition, operation_code, account_id, current_balance,
               currency, transaction_timestamp, source_commit_lsn, operation_type
        FROM silver"""
    ),
    "visible_after_compaction": _with(
        """
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type
        FROM retained"""
    ),
    "compaction_history": _with(
        """
        SELECT CAST(0 AS BIGINT) AS version, 'SOFT DELETE' AS operation,
               (SELECT COUNT(*) FROM silver) AS rows_before,
               (SELECT COUNT(*) FROM superseded) AS rows_invalidated,
               (SELECT COUNT(*) FROM retained) AS rows_after
        UNION ALL
        SELECT CAST(1 AS BIGINT), 'SOFT DELETE',
               (SELECT COUNT(*) FROM retained), CAST(0 AS BIGINT), (SELECT COUNT(*) FROM retained)"""
    ),
    "history_last_5": _with(
        """
        SELECT CAST(v AS BIGINT) AS version, (SELECT COUNT(*) FROM retained) AS rows_before,
               CAST(0 AS BIGINT) AS rows_invalidated
        FROM generate_series(5, 1, -1) t(v) ORDER BY version DESC"""
    ),
    "visible_after_replay": _with(
        """
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type FROM retained
        UNION ALL
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type FROM silver"""
    ),
    "visible_arranged": _with(RUN_CTES + """
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type FROM second_out"""),
    "visible_arranged_replay": _with(
        """
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type FROM retained
        UNION ALL
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type FROM silver"""
    ),
    "gold_by_aggregate": _with("SELECT * FROM gold"),
    "latest_merged": _with("""
        SELECT account_id, current_balance, currency, transaction_timestamp, source_commit_lsn, operation_type FROM latest"""),
    "sized_sink": _with("""
        SELECT kafka_event_offset, kafka_partition, operation_code, account_id, current_balance, currency,
               transaction_timestamp, source_commit_lsn, operation_type FROM silver"""),
    "lost_offsets": f"""
        WITH arrived AS (
          SELECT CAST(event_id % 3 AS INTEGER) AS kafka_partition, event_id // 3 AS o FROM events
          WHERE event_id % {LOST_EVERY} NOT BETWEEN {LOST_FROM} AND {LOST_FROM + LOST_RECORDS - 1}
          UNION ALL SELECT CAST(event_id % 3 AS INTEGER), unnest([-1, n]) FROM (SELECT event_id % 3 AS event_id, max(event_id // 3) + 3 AS n FROM events GROUP BY 1)),
        gaps AS (SELECT *, lag(o) OVER (PARTITION BY kafka_partition ORDER BY o) AS p FROM arrived)
        SELECT kafka_partition, p + 1 AS first_lost, o - 1 AS last_lost, o - p - 1 AS lost FROM gaps WHERE o - p > 1""",
    "change_lateness": _with("""
        SELECT account_id, COUNT(*) AS changes, COUNT(*) FILTER (WHERE lag > 0) AS late, CAST(GREATEST(COALESCE(MAX(lag), 0), 0) AS BIGINT) AS largest_lag
        FROM (SELECT account_id, MAX(source_commit_lsn) OVER (PARTITION BY account_id ORDER BY kafka_event_offset
                RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - source_commit_lsn AS lag FROM silver)
        GROUP BY account_id"""),
    "restart_delivery": _with("""
        SELECT kafka_partition, COUNT(*) AS fed, COUNT(*) AS landed, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS repeated,
               CAST(2 AS BIGINT) AS runs, CAST(6 AS BIGINT) AS batches
        FROM silver GROUP BY kafka_partition"""),
    "ingest_stamps": _with("""
        SELECT CAST(6 AS BIGINT) AS batches, COUNT(*) AS rows, CAST(6 AS BIGINT) AS one_stamp, CAST(6 AS BIGINT) AS later_stamp,
               CAST(6 AS BIGINT) AS as_observed FROM silver"""),
    "parse_faults": f"""
        WITH e AS (SELECT CAST(0 AS INTEGER) AS kafka_partition, event_id AS kafka_event_offset, event_id AS n FROM events),
        sound AS (SELECT * FROM e WHERE n % {TORN_EVERY} <> 0)
        SELECT kafka_partition, kafka_event_offset, 'malformed' AS field, NULL AS found FROM e WHERE n % {TORN_EVERY} = 0
        UNION ALL SELECT kafka_partition, kafka_event_offset, 'after', 'BIGINT' FROM sound WHERE n % {FLAT_AFTER_EVERY} = 0
        UNION ALL SELECT kafka_partition, kafka_event_offset, 'after.account_id', 'STRING' FROM sound
          WHERE n % {FLAT_AFTER_EVERY} <> 0 AND n % {TEXT_KEY_EVERY} = 0
        UNION ALL SELECT kafka_partition, kafka_event_offset, 'after.current_balance', 'STRING' FROM sound
          WHERE n % {FLAT_AFTER_EVERY} <> 0 AND n % {TEXT_BALANCE_EVERY} = 0
        UNION ALL SELECT kafka_partition, kafka_event_offset, 'source.lsn', 'DECIMAL(' || (length(CAST(n AS VARCHAR)) + (n > 0)::INT) || ',1)' FROM sound
          WHERE n % {DECIMAL_LSN_EVERY} = 0""",
    "visible_after_new_rows": _with(RUN_CTES + """
        SELECT kafka_partition, kafka_event_offset, account_id, source_commit_lsn, operation_type FROM second_out"""),
    "compaction_new_rows": _with(RUN_CTES + """
        SELECT CAST(0 AS BIGINT) AS version, n AS rows_before, n - k AS rows_invalidated, k AS rows_after
        FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE key_text IN (SELECT key_text FROM first_latest)) AS k
              FROM early WHERE is_early)
        UNION ALL
        SELECT CAST(1 AS BIGINT), n, n - k, k
        FROM (SELECT COUNT(*) AS n, (SELECT COUNT(*) FROM second_out) AS k FROM second_in)"""),
    "mutations_applied": _with(MUTATION_CTES + """
        SELECT seq, account_id, op, current_balance, currency FROM decided WHERE reason IS NULL"""),
    "mutations_rejected": _with(MUTATION_CTES + """
        SELECT seq, account_id, action, reason FROM decided WHERE reason IS NOT NULL"""),
    "mutations_sparse_seq": _with(MUTATION_CTES + f"""
        SELECT seq * {SPARSE_GAP} AS seq, account_id, action, reason,
               CASE WHEN reason IS NULL THEN op END AS op,
               CASE WHEN reason IS NULL THEN current_balance END AS current_balance FROM decided"""),
    "delta_fold": _with(DELTA_CTES + """
        SELECT seq, account_id,
               CASE action WHEN 'insert' THEN 'c' WHEN 'update' THEN 'u' ELSE 'd' END AS op,
               CASE WHEN NOT is_del THEN CAST(bal AS DOUBLE) END AS current_balance
        FROM s4 WHERE action <> 'seed' AND (is_set OR is_add OR is_del)"""),
    "insert_if_absent": _with(MUTATION_CTES + """
        SELECT seq, account_id, balance FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY seq) AS rn
          FROM req WHERE action = 'insert' AND balance IS NOT NULL AND account_id IS NOT NULL) f
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM gold WHERE gold.account_id = f.account_id)"""),
    "gold_after_mutations": _with(MUTATION_CTES + f"""
        , after AS (
          SELECT account_id, current_balance, currency, transaction_timestamp, source_commit_lsn,
                 operation_type, kafka_event_offset, kafka_partition FROM silver
          UNION ALL
          SELECT account_id,
                 CASE WHEN op <> 'd' THEN current_balance END,
                 CASE WHEN op <> 'd' THEN currency END,
                 CASE WHEN op <> 'd' THEN strftime(TIMESTAMP '{MUTATION_COMMIT_TS}', '%Y-%m-%dT%H:%M:%S.%fZ') END,
                 {MUTATION_BASE_LSN} + seq,
                 CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' ELSE 'DELETE' END,
                 {MUTATION_BASE_LSN} + seq,
                 CAST(account_id % 3 AS INTEGER)
          FROM decided WHERE reason IS NULL)
        SELECT {GOLD_COLS} FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id
                     ORDER BY source_commit_lsn DESC NULLS LAST, kafka_event_offset DESC NULLS LAST,
                              kafka_partition DESC NULLS LAST) AS rn3
          FROM after) a
        WHERE rn3 = 1 AND operation_type <> 'DELETE'"""),
    "gold_incremental": _with(f"SELECT {GOLD_COLS} FROM gold"),
    "gold_preview": _with(f"SELECT {GOLD_COLS} FROM gold ORDER BY account_id NULLS FIRST LIMIT 50"),
}
