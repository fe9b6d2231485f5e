"""Named queries over the driver's tables: each takes ``(spark, sf_dir)`` and
returns a lazy DataFrame. The change feed is derived from ``events`` and
``customer`` by Spark (see :mod:`tidemark.sources.feed`), so the work of every
query grows with those tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import audit, faults, maintenance, mutations, snapshot, state
from ..operators.ingest import to_silver
from ..session import new_work_path
from ..sources import feed, tables
from ..streaming import ingest as streaming
from ..streaming import progress, sized
from ..table import ChangeTable

# Fixed value: the account used for point lookups (present at every scale).
LOOKUP_ACCOUNT = 42

# Columns of silver that do not depend on when the ingest ran.
SILVER_STABLE = [
    "kafka_event_offset",
    "kafka_partition",
    "operation_code",
    "account_id",
    "current_balance",
    "currency",
    "transaction_timestamp",
    "source_commit_lsn",
    "operation_type",
]
GOLD_COMPARABLE = [c for c in schemas.GOLD_COLUMNS if c != "surrogate_key"]


# Silver tables written in this process: (application, sf_dir, exact) -> path.
_SILVER_TABLES: dict[tuple, str] = {}


def fixture_silver(spark: SparkSession, sf_dir: str, exact_decimal: bool = False) -> DataFrame:
    """Silver for the test feed, as a table.

    The feed is ingested once per session by the batch ingest path into the
    shared folder; queries then read it like the real table, so their plans start
    from a Parquet scan (with pruning and pushdown) instead of re-deriving and
    re-parsing the feed in every branch.
    """
    cache_key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), exact_decimal)
    path = _SILVER_TABLES.get(cache_key)
    if path is None:
        path = new_work_path(spark, "silver-" + os.path.basename(sf_dir.rstrip("/"))) + "/silver"
        streaming.ingest_batch(feed.fixture_feed(spark, sf_dir), path, exact_decimal=exact_decimal)
        _SILVER_TABLES[cache_key] = path
    schema = schemas.silver(schemas.BALANCE_DECIMAL) if exact_decimal else schemas.SILVER
    return tables.read_silver(spark, path, schema)


def parsed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test feed parsed on the fly (no table in between)."""
    return to_silver(feed.fixture_feed(spark, sf_dir))


def silver_parsed(spark, sf_dir):
    """Parse + type + key the feed (P1-P5), straight from the records."""
    return parsed_feed(spark, sf_dir).select(*SILVER_STABLE)


def surrogate_key_stats(spark, sf_dir):
    return audit.key_stats(fixture_silver(spark, sf_dir))


def duplicate_keys(spark, sf_dir):
    return audit.duplicate_keys(fixture_silver(spark, sf_dir)).drop("surrogate_key")


def event_month_counts(spark, sf_dir):
    silver = fixture_silver(spark, sf_dir)
    return (
        silver.where(F.col("transaction_timestamp").isNotNull())
        .groupBy("event_month")
        .agg(F.count(F.lit(1)).alias("events"))
    )


# Arrival stamps of the queries that compare them.
ARRIVALS = ("2024-05-01 00:00:00", "2024-06-01 00:00:00")


def event_month_all(spark, sf_dir):
    """Month of every row, of the event or, for deletes and junk, of the arrival."""
    silver = to_silver(feed.fixture_feed(spark, sf_dir), ingested_at=F.lit(ARRIVALS[0]).cast("timestamp"))
    return silver.groupBy("event_month").agg(F.count(F.lit(1)).alias("events"))


def silver_newest_arrivals(spark, sf_dir):
    """The newest 100 rows of two arrivals (even offsets came first), with the total."""
    stamp = F.when(F.col("kafka_event_offset") % 2 == 0, F.lit(ARRIVALS[0])).otherwise(F.lit(ARRIVALS[1]))
    silver = to_silver(feed.fixture_feed(spark, sf_dir), ingested_at=stamp)
    rows = audit.preview(silver, 100, ["kafka_partition", "kafka_event_offset", "account_id", "ingested_at"])
    return rows.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


def gold_current(spark, sf_dir):
    return state.current_state(fixture_silver(spark, sf_dir)).select(*GOLD_COMPARABLE).orderBy("account_id")


def gold_sql(spark, sf_dir):
    """The gold view through Spark SQL over registered views."""
    state.register_views(spark, fixture_silver(spark, sf_dir))
    return spark.sql(
        "SELECT " + ", ".join(GOLD_COMPARABLE) + " FROM gold_accounting_current ORDER BY account_id"
    )


def gold_lookup(spark, sf_dir):
    gold = state.current_state(fixture_silver(spark, sf_dir))
    return state.lookup(gold, LOOKUP_ACCOUNT).select(*GOLD_COMPARABLE)


def latest_changes(spark, sf_dir):
    """Newest change per key, tombstones included."""
    return state.latest_changes(fixture_silver(spark, sf_dir)).select(*GOLD_COMPARABLE)


def silver_total(spark, sf_dir):
    return audit.silver_total(fixture_silver(spark, sf_dir))


def event_mix(spark, sf_dir):
    return audit.event_mix(fixture_silver(spark, sf_dir))


def silver_newest(spark, sf_dir):
    cols = [c for c in schemas.PREVIEW_COLUMNS if c not in ("surrogate_key", "event_month", "ingested_at")]
    return audit.newest(fixture_silver(spark, sf_dir), 100, cols)


def superseded_rows(spark, sf_dir):
    rows = maintenance.superseded(fixture_silver(spark, sf_dir))
    return rows.select("kafka_partition", "kafka_event_offset", "account_id", "source_commit_lsn", "operation_type")


def compaction_counts(spark, sf_dir):
    return maintenance.compaction_counts(fixture_silver(spark, sf_dir))


def gold_after_compaction(spark, sf_dir):
    silver = fixture_silver(spark, sf_dir)
    invalid = maintenance.superseded(silver).select(*schemas.ROW_IDENTITY)
    return state.current_state(maintenance.visible(silver, invalid)).select(*GOLD_COMPARABLE)


def retained_rows(spark, sf_dir):
    rows = maintenance.retained(fixture_silver(spark, sf_dir))
    return rows.select("kafka_partition", "kafka_event_offset", "account_id", "source_commit_lsn", "operation_type")


def replay_invariance(spark, sf_dir):
    silver = fixture_silver(spark, sf_dir)
    # Redeliver every record with its original offsets: silver grows, gold must not move.
    replay = parsed_feed(spark, sf_dir)
    return audit.replay_invariance(silver, replay)


def source_table(spark, sf_dir):
    """Source table after all changes in commit order (S7); times shown as UTC wall clock."""
    snap = tables.source_snapshot(tables.source_from_changes(feed.fixture_changes(spark, sf_dir)))
    return snap.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("transaction_timestamp", "updated_at")})


def source_reconcile(spark, sf_dir):
    source = tables.source_from_changes(feed.fixture_changes(spark, sf_dir))
    gold = state.current_state(fixture_silver(spark, sf_dir))
    return audit.reconcile_summary(source, gold)


def source_reconcile_rows(spark, sf_dir):
    """Per-account reconciliation status (D2), with both sides' balances."""
    source = tables.source_from_changes(feed.fixture_changes(spark, sf_dir))
    gold = state.current_state(fixture_silver(spark, sf_dir))
    return audit.reconcile(source, gold).select("account_id", "status", "source_balance", "gold_balance")


# Fixed value: gold misses every 37th account of the digest query and has other balances for every 41st.
MISSING_EVERY, OTHER_BALANCE_EVERY = 37, 41


def reconcile_by_digest(spark, sf_dir):
    """Reconciliation that joins only key ranges whose digests differ (D2), against a gold with planted differences."""
    source = tables.source_from_changes(feed.fixture_changes(spark, sf_dir))
    account = F.coalesce("account_id", F.lit(1))
    gold = state.current_state(fixture_silver(spark, sf_dir)).where(account % MISSING_EVERY != 0).withColumn(
        "current_balance", F.when(account % OTHER_BALANCE_EVERY == 0, F.col("current_balance") + 1).otherwise(F.col("current_balance")))
    return audit.reconcile_by_digest(source, gold).select("account_id", "status", "source_balance", "gold_balance")


def health_counts(spark, sf_dir):
    return audit.health_counts(fixture_silver(spark, sf_dir))


def gold_decimal(spark, sf_dir):
    silver = fixture_silver(spark, sf_dir, exact_decimal=True)
    return state.current_state(silver).select(*GOLD_COMPARABLE)


def stream_vs_batch(spark, sf_dir):
    """The feed written as files, ingested by Structured Streaming (``availableNow``,
    in six micro-batches) into a month-partitioned Parquet sink, read back."""
    root = new_work_path(spark, "stream-vs-batch")
    records = feed.fixture_feed(spark, sf_dir)
    each = feed.files_each(records, 6)
    feed.write_files(records, root + "/feed", 6, each)
    streaming.ingest_available(feed.file_stream(spark, root + "/feed", max_files_per_trigger=each), root + "/silver")
    return tables.read_silver(spark, root + "/silver").select(*SILVER_STABLE)


def _compacted_table(spark, sf_dir, runs: int = 1) -> str:
    root = new_work_path(spark, "compaction")
    path = root + "/silver"
    streaming.ingest_batch(feed.fixture_feed(spark, sf_dir), path)
    for _ in range(runs):
        maintenance.compact(spark, tables.read_silver(spark, path), path)
    return path


def visible_after_compaction(spark, sf_dir):
    """Silver as readers see it after one real compaction run (its tables written)."""
    path = _compacted_table(spark, sf_dir)
    vis = maintenance.visible_rows(spark, tables.read_silver(spark, path), path)
    return vis.select("kafka_partition", "kafka_event_offset", "account_id", "source_commit_lsn", "operation_type")


def compaction_history(spark, sf_dir):
    """History after two runs: the second invalidates nothing."""
    path = _compacted_table(spark, sf_dir, runs=2)
    hist = maintenance.read_history(spark, path)
    m = F.col("metrics")
    return hist.select(
        "version",
        "operation",
        m["numRowsBefore"].cast("long").alias("rows_before"),
        m["numDeletedRows"].cast("long").alias("rows_invalidated"),
        m["numRowsAfter"].cast("long").alias("rows_after"),
    )


def history_last_5(spark, sf_dir):
    """The last five of six runs, newest first (T3); the first run hides rows, the others find none."""
    path = _compacted_table(spark, sf_dir, runs=6)
    m = F.col("metrics")
    return maintenance.recent_history(spark, path).select(
        "version", m["numRowsBefore"].cast("long").alias("rows_before"), m["numDeletedRows"].cast("long").alias("rows_invalidated"))


# Fixed value: feed records stamped before this instant arrive before the snapshot.
SNAPSHOT_CUT = "2024-01-15 00:00:00"


def gold_incremental(spark, sf_dir):
    """Gold from a state snapshot plus what arrived after it: the feed comes in three arrivals
    (by record time and offset), a snapshot after the first, the last one as a backfill."""
    root = new_work_path(spark, "incremental")
    path, backfill = root + "/silver", root + "/silver_backfill"
    records = feed.fixture_feed(spark, sf_dir)
    early = F.coalesce(F.col("timestamp") < F.lit(SNAPSHOT_CUT).cast("timestamp"), F.lit(False))
    third = F.pmod("offset", F.lit(3)) == 0
    streaming.ingest_batch(records.where(early), path)
    snapshot.write_snapshot(spark, path)
    streaming.ingest_batch(records.where(~early & ~third), path)
    streaming.ingest_batch(records.where(~early & third), backfill)
    return snapshot.current_state_incremental(spark, path, more=tables.read_silver(spark, backfill)).select(*GOLD_COMPARABLE)


def visible_after_replay(spark, sf_dir):
    """One run, then the whole feed once more with its positions: what the run kept and every replayed row."""
    path = _compacted_table(spark, sf_dir)
    streaming.ingest_batch(feed.fixture_feed(spark, sf_dir), path)
    vis = maintenance.visible_rows(spark, tables.read_silver(spark, path), path)
    return vis.select("kafka_partition", "kafka_event_offset", "account_id", "source_commit_lsn", "operation_type")


def _compacted_arrivals(spark, sf_dir, buckets: int | None = None) -> ChangeTable:
    """A run after the early records, another after the later ones, a third of which are a backfill;
    with ``buckets``, the layout follows each run."""
    t = ChangeTable(spark, new_work_path(spark, "arrivals"))

    def compact() -> None:
        t.compact()
        if buckets:
            t.arrange(buckets)

    records = feed.fixture_feed(spark, sf_dir)
    early = F.coalesce(F.col("timestamp") < F.lit(SNAPSHOT_CUT).cast("timestamp"), F.lit(False))
    third = F.pmod("offset", F.lit(3)) == 0
    streaming.ingest_batch(records.where(early), t.silver_path)
    compact()
    streaming.ingest_batch(records.where(~early & ~third), t.silver_path)
    t.backfill(records.where(~early & third))
    compact()
    return t


def visible_after_new_rows(spark, sf_dir):
    """Visible rows after two runs, of which the second read only what had arrived since the first."""
    return _compacted_arrivals(spark, sf_dir).visible().select(
        "kafka_partition", "kafka_event_offset", "account_id", "source_commit_lsn", "operation_type")


# Fixed value: buckets of the queries' layouts.
LAYOUT_BUCKETS = 4


def visible_arranged(spark, sf_dir):
    """The same rows, read from a bucketed layout that followed both runs."""
    return _compacted_arrivals(spark, sf_dir, LAYOUT_BUCKETS).visible().select(
        "kafka_partition", "kafka_event_offset", "account_id", "source_commit_lsn", "operation_type")


def visible_arranged_replay(spark, sf_dir):
    """A layout after the first run of two, then the whole feed once more: the second run and its later rows
    are read beside the older layout."""
    t = ChangeTable(spark, new_work_path(spark, "arranged"))
    records = feed.fixture_feed(spark, sf_dir)
    streaming.ingest_batch(records, t.silver_path)
    t.compact()
    t.arrange(LAYOUT_BUCKETS)
    t.compact()
    streaming.ingest_batch(records, t.silver_path)
    return t.visible().select("kafka_partition", "kafka_event_offset", "account_id", "source_commit_lsn", "operation_type")


def compaction_new_rows(spark, sf_dir):
    """History of the same two runs."""
    m = F.col("metrics")
    return _compacted_arrivals(spark, sf_dir).history().select(
        "version",
        m["numRowsBefore"].cast("long").alias("rows_before"),
        m["numDeletedRows"].cast("long").alias("rows_invalidated"),
        m["numRowsAfter"].cast("long").alias("rows_after"),
    )


# How the test mutation batches are derived from ``events``.
NO_BALANCE_EVERY = 13  # requests without a balance
EUR_EVERY = 11
NO_CURRENCY_EVERY = 17
EMPTY_CURRENCY_EVERY = 19
DELTA_CENTER = 50.0  # update delta = value - 50


def _event_actions(events: DataFrame) -> F.Column:
    et = F.col("event_type")
    return F.when(et == "signup", "insert").when(et == "error", "delete").otherwise("update")


def mutation_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request batch (seq, action, account_id, balance, currency) from ``events``."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    eid = F.col("event_id")
    return ev.select(
        eid.alias("seq"),
        _event_actions(ev).alias("action"),
        F.col("user_id").alias("account_id"),
        F.when(eid % NO_BALANCE_EVERY == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("balance"),
        F.when(eid % EUR_EVERY == 0, "EUR")
        .when(eid % NO_CURRENCY_EVERY == 0, F.lit(None).cast("string"))
        .when(eid % EMPTY_CURRENCY_EVERY == 0, "")
        .otherwise("USD")
        .alias("currency"),
    )


def delta_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relative-update batch (seq, action, account_id, amount) from ``events``."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    action = _event_actions(ev)
    amount = F.when(action == "update", F.col("value") - F.lit(DELTA_CENTER)).when(action == "insert", F.col("value"))
    return ev.select(F.col("event_id").alias("seq"), action.alias("action"), F.col("user_id").alias("account_id"), amount.alias("amount"))


def _gold(spark, sf_dir):
    return state.current_state(fixture_silver(spark, sf_dir))


def mutations_applied(spark, sf_dir):
    return mutations.apply_mutations(mutation_requests(spark, sf_dir), _gold(spark, sf_dir))


def mutations_rejected(spark, sf_dir):
    return mutations.rejected_mutations(mutation_requests(spark, sf_dir), _gold(spark, sf_dir))


def delta_fold(spark, sf_dir):
    return mutations.delta_fold(delta_requests(spark, sf_dir), _gold(spark, sf_dir))


# Fixed value: gap between the positions of the sparse batches.
SPARSE_GAP = 10_000_000


def mutations_sparse_seq(spark, sf_dir):
    """Every request of a batch with wide gaps between its positions, and its verdict."""
    sparse = mutation_requests(spark, sf_dir).withColumn("seq", F.col("seq") * SPARSE_GAP)
    judged = mutations.judge_mutations(sparse, _gold(spark, sf_dir))
    return judged.select("seq", "account_id", "action", "reason", "op", "current_balance")


# Where the mutation batch lands in the feed.
MUTATION_BASE_LSN = 10**16  # past every lsn and offset of the feed
MUTATION_COMMIT_TS = "2024-03-01 00:00:00"


def gold_after_mutations(spark, sf_dir):
    """End to end: judge a batch against gold, publish the applied events as change
    envelopes, ingest them next to the existing feed, resolve gold again."""
    silver = fixture_silver(spark, sf_dir)
    applied = mutations.apply_mutations(mutation_requests(spark, sf_dir), state.current_state(silver))
    changes = mutations.mutation_changes(applied, MUTATION_BASE_LSN, MUTATION_COMMIT_TS)
    new_rows = to_silver(feed.envelope_records(changes))
    return state.current_state(silver.unionByName(new_rows)).select(*GOLD_COMPARABLE)


def gold_preview(spark, sf_dir):
    """Gold ordered by key, first 50 rows (the report's presentation)."""
    return state.current_state(fixture_silver(spark, sf_dir)).select(*GOLD_COMPARABLE).orderBy(
        F.col("account_id").asc_nulls_first()
    ).limit(50)


def insert_if_absent(spark, sf_dir):
    reqs = mutation_requests(spark, sf_dir)
    return mutations.insert_if_absent(reqs, _gold(spark, sf_dir)).select("seq", "account_id", "balance")


def gold_by_aggregate(spark, sf_dir):
    """Gold through the mergeable aggregate instead of the window (A3)."""
    return state.current_state_by_aggregate(fixture_silver(spark, sf_dir)).select(*GOLD_COMPARABLE)


def latest_merged(spark, sf_dir):
    """Newest change per key, merged from the aggregates of three parts of the table (A3)."""
    silver = fixture_silver(spark, sf_dir).select(*dict.fromkeys([*GOLD_COMPARABLE, *state.ORDER]))
    third = F.pmod("kafka_event_offset", F.lit(3))
    parts = [state.latest_by_aggregate(silver.where(third == i)) for i in range(3)]
    return state.latest_by_aggregate(parts[0].unionByName(parts[1]).unionByName(parts[2])).select(*GOLD_COMPARABLE)


# Fixed values of the sized sink's query: micro-batches, and the file size it aims at.
SIZED_BATCHES = 6
SIZED_TARGET = 64 << 10


def sized_sink(spark, sf_dir):
    """The feed through the sink with file-size control, packed after the stream."""
    root = new_work_path(spark, "sized")
    records = feed.fixture_feed(spark, sf_dir)
    each = feed.files_each(records, SIZED_BATCHES)
    feed.write_files(records, root + "/feed", SIZED_BATCHES, each)
    query = sized.start_sized_ingest(feed.file_stream(spark, root + "/feed", max_files_per_trigger=each), root + "/silver", target_bytes=SIZED_TARGET)
    query.awaitTermination()
    sized.pack(spark, root + "/silver", SIZED_TARGET)
    return tables.read_silver(spark, root + "/silver").select(*SILVER_STABLE)


# Every 1,000 events, this many records are lost from the third hundred on; every 20th comes twice.
LOST_EVERY, LOST_FROM, LOST_RECORDS, TWICE_EVERY = 1000, 300, 31, 20


def lost_offsets(spark, sf_dir):
    """Feed positions that never arrived (S1), from records of ``events`` with blocks left out."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id")
    records = events.select(F.lit("{}").alias("value"), F.expr("event_id div 3").alias("offset"), (n % 3).cast("int").alias("partition"),
                            F.col("ts").cast("timestamp").alias("timestamp"), n)
    kept = records.where(~(n % LOST_EVERY).between(LOST_FROM, LOST_FROM + LOST_RECORDS - 1))
    twice = kept.where(n % TWICE_EVERY == 0)
    silver = to_silver(kept.unionByName(twice).drop("event_id"))
    expected = records.groupBy("partition").agg(F.lit(0).cast("long").alias("first"), (F.max("offset") + 3).alias("next"))
    return audit.lost_offsets(silver, expected)


def change_lateness(spark, sf_dir):
    """Late changes and the largest lag of each account."""
    return audit.lateness(fixture_silver(spark, sf_dir))


def _two_runs(spark, sf_dir):
    """(root, feed, reports): a stream over the first files of the feed, stopped after its first micro-batch,
    and started again over all of them."""
    root = new_work_path(spark, "restart")
    records = feed.fixture_feed(spark, sf_dir)
    early = F.coalesce(F.col("timestamp") < F.lit(SNAPSHOT_CUT).cast("timestamp"), F.lit(False))
    # of the lesser side, so that none of its files is empty: an empty one is not written
    each = min(feed.files_each(records.where(early), 3), feed.files_each(records.where(~early), 3))
    feed.write_files(records.where(early), root + "/feed", 3, each)
    source = lambda: feed.file_stream(spark, root + "/feed", max_files_per_trigger=each)
    with progress.BatchReports(spark) as reports:
        first = streaming.start_ingest(source(), root + "/silver", mode="stream", interval="0 seconds")
        try:
            reports.wait_for(first, batches=1)
        finally:
            first.stop()  # whatever micro-batch it is in
        feed.write_files(records.where(~early), root + "/feed", 3, each, mode="append")
        second = streaming.start_ingest(source(), root + "/silver")
        second.awaitTermination()
        reports.wait_for(second)
    return root, feed.file_batch(spark, root + "/feed"), reports.table()


def restart_delivery(spark, sf_dir):
    """Each record lands exactly once although the stream was stopped and restarted (R2)."""
    root, records, reports = _two_runs(spark, sf_dir)
    runs = reports.agg(F.count_distinct("run_id").alias("runs"))
    committed = progress.sink_log(spark, root + "/silver").agg(F.count_distinct("batch_id").alias("batches"))
    landed = audit.delivery(records, tables.read_silver(spark, root + "/silver"))
    return landed.withColumn("runs", runs.scalar()).withColumn("batches", committed.scalar())


def ingest_stamps(spark, sf_dir):
    """One stamp for each micro-batch, later than the one before, from the stream's own clock."""
    root = new_work_path(spark, "stamps")
    records = feed.fixture_feed(spark, sf_dir)
    each = feed.files_each(records, 6)
    feed.write_files(records, root + "/feed", 6, each)
    with progress.BatchReports(spark) as reports:
        query = streaming.ingest_available(feed.file_stream(spark, root + "/feed", max_files_per_trigger=each), root + "/silver")
        reports.wait_for(query)
    stored = progress.stamps_by_batch(tables.read_silver(spark, root + "/silver"), progress.sink_log(spark, root + "/silver"))
    return progress.stamp_check(reports.table(), stored)


# Of every so many events, the payload has a field of another type, or is no JSON.
TEXT_KEY_EVERY, TEXT_BALANCE_EVERY, DECIMAL_LSN_EVERY, FLAT_AFTER_EVERY, TORN_EVERY = 50, 70, 90, 110, 130


def parse_faults(spark, sf_dir):
    """Fields that the typed parse nulled for their type, from payloads of ``events`` with wrong types in them."""
    n = F.col("event_id")
    key = F.when(n % TEXT_KEY_EVERY == 0, F.concat(F.lit('"'), F.col("user_id"), F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    balance = F.when(n % TEXT_BALANCE_EVERY == 0, F.lit('"1.5"')).otherwise(F.lit("2.5"))
    lsn = F.when(n % DECIMAL_LSN_EVERY == 0, F.concat(n, F.lit(".5"))).otherwise(n.cast("string"))
    after = F.when(n % FLAT_AFTER_EVERY == 0, F.lit("7")).otherwise(
        F.concat(F.lit('{"account_id":'), key, F.lit(',"current_balance":'), balance, F.lit(',"currency":null}')))
    payload = F.concat(F.lit('{"op":"u","after":'), after, F.lit(',"source":{"lsn":'), lsn, F.lit("}}"))
    records = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.when(n % TORN_EVERY == 0, F.substring(payload, 1, 20)).otherwise(payload).alias("value"), n.alias("offset"),
        F.lit(0).alias("partition"), F.col("ts").cast("timestamp").alias("timestamp"))
    return faults.field_faults(records)


QUERIES = {
    "gold_by_aggregate": gold_by_aggregate,
    "latest_merged": latest_merged,
    "sized_sink": sized_sink,
    "lost_offsets": lost_offsets,
    "change_lateness": change_lateness,
    "restart_delivery": restart_delivery,
    "ingest_stamps": ingest_stamps,
    "parse_faults": parse_faults,
    "reconcile_by_digest": reconcile_by_digest,
    "silver_parsed": silver_parsed,
    "surrogate_key_stats": surrogate_key_stats,
    "duplicate_keys": duplicate_keys,
    "event_month_counts": event_month_counts,
    "event_month_all": event_month_all,
    "silver_newest_arrivals": silver_newest_arrivals,
    "gold_current": gold_current,
    "gold_sql": gold_sql,
    "gold_lookup": gold_lookup,
    "latest_changes": latest_changes,
    "silver_total": silver_total,
    "event_mix": event_mix,
    "silver_newest": silver_newest,
    "superseded_rows": superseded_rows,
    "retained_rows": retained_rows,
    "compaction_counts": compaction_counts,
    "gold_after_compaction": gold_after_compaction,
    "replay_invariance": replay_invariance,
    "source_table": source_table,
    "source_reconcile": source_reconcile,
    "source_reconcile_rows": source_reconcile_rows,
    "health_counts": health_counts,
    "gold_decimal": gold_decimal,
    "stream_vs_batch": stream_vs_batch,
    "visible_after_compaction": visible_after_compaction,
    "compaction_history": compaction_history,
    "history_last_5": history_last_5,
    "visible_after_replay": visible_after_replay,
    "visible_after_new_rows": visible_after_new_rows,
    "visible_arranged": visible_arranged,
    "visible_arranged_replay": visible_arranged_replay,
    "compaction_new_rows": compaction_new_rows,
    "mutations_applied": mutations_applied,
    "mutations_rejected": mutations_rejected,
    "mutations_sparse_seq": mutations_sparse_seq,
    "delta_fold": delta_fold,
    "insert_if_absent": insert_if_absent,
    "gold_after_mutations": gold_after_mutations,
    "gold_preview": gold_preview,
    "gold_incremental": gold_incremental,
}
