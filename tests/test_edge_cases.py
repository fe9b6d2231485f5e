"""Edge rows of the change-feed semantics."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import maintenance, state
from tidemark.operators.ingest import to_silver

INGEST = "2025-06-15 00:00:00"


def env(op, account=None, lsn=None, balance=None, currency="USD", ts="2024-01-01T00:00:00.000000Z", before=None):
    image = None
    if account is not None or balance is not None:
        image = {
            "account_id": account,
            "current_balance": balance,
            "currency": currency,
            "transaction_timestamp": ts,
            "updated_at": ts,
        }
    doc = {"before": None, "after": image, "source": {"lsn": lsn, "ts_ms": 0}, "op": op, "ts_ms": 0}
    if op == "d":
        doc["before"] = before or {"account_id": account}
        doc["after"] = None
    return json.dumps(doc)


def silver_of(spark, records, exact_decimal=False):
    """records: list of (value, offset[, partition])."""
    rows = [(r[0], r[1], r[2] if len(r) > 2 else 0, None) for r in records]
    feed = spark.createDataFrame(rows, schemas.FEED)
    return to_silver(feed, F.lit(INGEST), exact_decimal=exact_decimal)


def by_offset(df):
    return {r["kafka_event_offset"]: r for r in df.collect()}


def test_silver_schema_and_order(spark):
    s = silver_of(spark, [(env("c", 1, 1, 1.0), 1)])
    assert s.columns == schemas.SILVER_COLUMNS
    assert [f.dataType for f in s.schema.fields] == [f.dataType for f in schemas.SILVER.fields]


@pytest.mark.parametrize("value", ["{bad", None, "{}"])
def test_malformed_payload_kept(spark, value):
    r = silver_of(spark, [(value, 5)]).first()
    assert r["raw_json"] == value
    assert r["account_id"] is None and r["source_commit_lsn"] is None and r["current_balance"] is None
    assert r["operation_type"] == "UNKNOWN"
    assert r["event_month"] == "2025-06"  # ingest month


def test_op_mapping_and_unlisted_op(spark):
    recs = [(env(op, 1, i, 1.0), i) for i, op in enumerate(["c", "r", "u", "d", "t"], start=1)]
    got = {r["operation_code"]: r["operation_type"] for r in silver_of(spark, recs).collect()}
    assert got == {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE", "t": "UNKNOWN"}


def test_unknown_op_shown_in_gold_when_latest(spark):
    s = silver_of(spark, [(env("c", 1, 1, 1.0), 1), (env("t", 1, 2, 2.0), 2)])
    g = state.current_state(s).collect()
    assert len(g) == 1 and g[0]["operation_type"] == "UNKNOWN"


def test_delete_takes_key_from_before(spark):
    r = silver_of(spark, [(env("d", 1, 9), 1)]).first()
    assert r["account_id"] == 1 and r["operation_type"] == "DELETE"
    assert r["current_balance"] is None and r["currency"] is None and r["transaction_timestamp"] is None
    assert r["event_month"] == "2025-06"


def test_wrong_field_types_null_only_that_field(spark):
    recs = [
        ('{"after":{"account_id":"x","current_balance":1.5},"source":{"lsn":1},"op":"u"}', 1),
        ('{"after":{"account_id":1.0,"current_balance":2.5},"source":{"lsn":1},"op":"u"}', 2),
        ('{"after":{"account_id":"7","current_balance":3.5},"source":{"lsn":1},"op":"u"}', 3),
    ]
    rows = by_offset(silver_of(spark, recs))
    for off, bal in [(1, 1.5), (2, 2.5), (3, 3.5)]:
        assert rows[off]["account_id"] is None
        assert rows[off]["current_balance"] == bal
        assert rows[off]["source_commit_lsn"] == 1


def test_number_as_text_and_decimal_overflow(spark):
    recs = [
        ('{"after":{"account_id":1,"current_balance":"1.5"},"source":{"lsn":1},"op":"u"}', 1),
        ('{"after":{"account_id":2,"current_balance":99999999999999.999},"source":{"lsn":1},"op":"u"}', 2),
        ('{"after":{"account_id":3,"current_balance":1250.75},"source":{"lsn":1},"op":"u"}', 3),
    ]
    as_double = by_offset(silver_of(spark, recs))
    assert as_double[1]["current_balance"] is None
    exact = by_offset(silver_of(spark, recs, exact_decimal=True))
    assert str(exact[1]["current_balance"]) == "1.50"
    assert exact[2]["current_balance"] is None
    assert str(exact[3]["current_balance"]) == "1250.75"


def test_bad_timestamp_and_month_edge_utc(spark):
    recs = [
        (env("u", 1, 1, 1.0, ts="nope"), 1),
        (env("u", 2, 1, 1.0, ts="2024-01-01T01:00:00+02:00"), 2),
        (env("u", 3, 1, 1.0, ts="2024-02-29T23:59:59.999999Z"), 3),
    ]
    rows = by_offset(silver_of(spark, recs))
    assert rows[1]["event_month"] == "2025-06"
    assert rows[2]["event_month"] == "2023-12"
    assert rows[3]["event_month"] == "2024-02"


def test_month_is_utc_whatever_the_session_zone(spark):
    recs = [(env("u", 2, 1, 1.0, ts="2024-01-01T01:00:00+02:00"), 2), (env("u", 3, 1, 1.0, ts="2024-01-31T23:30:00Z"), 3)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = by_offset(silver_of(spark, recs))
            assert (rows[2]["event_month"], rows[3]["event_month"]) == ("2023-12", "2024-01"), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_envelope_timestamps_are_utc_whatever_the_session_zone(spark):
    import datetime as dt

    from tidemark.functions.envelope import envelope_timestamp

    instant = dt.datetime(2024, 1, 1, 0, 0, 7, 179575, tzinfo=dt.timezone.utc)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(instant,)], "ts timestamp")
            assert df.select(envelope_timestamp(F.col("ts"))).first()[0] == "2024-01-01T00:00:07.179575Z", zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_key_collision_through_nulls(spark):
    recs = [
        ('{"after":{"current_balance":1.0},"source":{"lsn":5},"op":"u"}', 1),
        ('{"after":{"account_id":5,"current_balance":1.0},"source":{},"op":"u"}', 2),
        ("{bad", 3),
    ]
    rows = by_offset(silver_of(spark, recs))
    assert rows[1]["surrogate_key"] == rows[2]["surrogate_key"]
    assert rows[3]["surrogate_key"] is not None


def test_duplicate_winner_and_compaction(spark):
    recs = [
        (env("c", 1, 1, 10.0), 1),
        (env("u", 1, 2, 20.0), 2),
        (env("u", 1, 2, 20.0), 7),  # redelivered copy of the winner
    ]
    s = silver_of(spark, recs)
    assert s.count() == 3
    g = state.current_state(s).collect()
    assert len(g) == 1 and g[0]["current_balance"] == 20.0
    kept = {r["kafka_event_offset"] for r in maintenance.retained(s).collect()}
    assert kept == {2, 7}  # both copies share the winner key and survive


def test_late_older_change_loses(spark):
    recs = [(env("u", 1, 5, 50.0), 1), (env("u", 1, 3, 30.0), 9)]
    g = state.current_state(silver_of(spark, recs)).collect()
    assert g[0]["current_balance"] == 50.0 and g[0]["source_commit_lsn"] == 5


def test_late_change_after_delete_stays_hidden(spark):
    recs = [(env("c", 1, 1, 1.0), 1), (env("d", 1, 4), 2), (env("u", 1, 3, 3.0), 3)]
    s = silver_of(spark, recs)
    assert state.current_state(s).count() == 0
    vis = maintenance.visible(s, maintenance.superseded(s).select(*schemas.ROW_IDENTITY))
    assert [r["operation_type"] for r in vis.collect()] == ["DELETE"]  # tombstone kept
    assert state.current_state(vis).count() == 0


def test_null_in_winner_not_backfilled(spark):
    recs = [(env("c", 1, 1, 1.0, currency="EUR"), 1), (env("u", 1, 2, 2.0, currency=None), 2)]
    g = state.current_state(silver_of(spark, recs)).first()
    assert g["currency"] is None and g["current_balance"] == 2.0


def test_null_key_is_one_gold_row(spark):
    recs = [("{bad", 1), ("{bad", 2), (None, 3), (env("c", 1, 1, 1.0), 4)]
    gold = state.current_state(silver_of(spark, recs))
    g = state.lookup(gold, None).collect()
    assert len(g) == 1 and g[0]["account_id"] is None and g[0]["operation_type"] == "UNKNOWN"
    assert state.lookup(gold, 1).count() == 1


def test_tie_on_lsn_and_offset_broken_by_partition(spark):
    recs = [(env("u", 1, 2, 1.0), 5, 0), (env("u", 1, 2, 2.0), 5, 2), (env("u", 1, 2, 3.0), 5, 1)]
    g = state.current_state(silver_of(spark, recs)).first()
    assert g["current_balance"] == 2.0


def test_null_lsn_sorts_last(spark):
    recs = [(env("u", 1, None, 9.0), 100), (env("u", 1, 1, 1.0), 1)]
    g = state.current_state(silver_of(spark, recs)).first()
    assert g["current_balance"] == 1.0


def test_gold_sql_view_equals_dataframe(spark):
    recs = [(env("c", k, l, float(l)), k * 10 + l, k % 3) for k in range(5) for l in range(1, 4)]
    recs.append((env("d", 2, 9), 99, 2))
    s = silver_of(spark, recs)
    state.register_views(spark, s, "edge_silver", "edge_gold")
    a = spark.table("edge_gold")
    b = state.current_state(s)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == 4


def test_pruned_parse_equals_full_envelope_parse(spark):
    """Parsing only the projected fields gives the same silver as the full envelope,
    also when unprojected fields are junk."""
    recs = [
        (env("c", 1, 1, 1.0), 1),
        ('{"before":{"account_id":"x","current_balance":{"a":1}},"after":{"account_id":2,"current_balance":[1],'
         '"currency":"EUR","transaction_timestamp":"2024-03-01T00:00:00Z","updated_at":{"x":1}},'
         '"source":{"lsn":"nope","ts_ms":"bad"},"op":"u","ts_ms":[1,2]}', 2),
        ('{"before":{"account_id":9},"after":"oops","source":{"lsn":4},"op":"d"}', 3),
        ("{bad", 4), (None, 5), ("{}", 6),
    ]
    pruned = silver_of(spark, recs)
    feed = spark.createDataFrame([(r[0], r[1], 0, None) for r in recs], schemas.FEED)
    full = feed.select(F.col("value").alias("raw_json"), F.col("offset").alias("o"),
                       F.from_json("value", schemas.ENVELOPE).alias("e"))
    got = {r["kafka_event_offset"]: (r["account_id"], r["current_balance"], r["currency"], r["source_commit_lsn"], r["operation_code"])
           for r in pruned.collect()}
    want = {r["o"]: (r["e"]["after"]["account_id"] if r["e"] and r["e"]["after"] and r["e"]["after"]["account_id"] is not None
                     else (r["e"]["before"]["account_id"] if r["e"] and r["e"]["before"] else None),
                     r["e"]["after"]["current_balance"] if r["e"] and r["e"]["after"] else None,
                     r["e"]["after"]["currency"] if r["e"] and r["e"]["after"] else None,
                     r["e"]["source"]["lsn"] if r["e"] and r["e"]["source"] else None,
                     r["e"]["op"] if r["e"] else None)
            for r in full.collect()}
    assert got == want
