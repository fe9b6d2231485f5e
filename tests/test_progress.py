"""Reports of micro-batches, the sink's commit log, losses, lateness, field faults, gold as an aggregate."""

import contextlib
import io
import os
import random

from pyspark.sql import functions as F

from tidemark.operators import audit, faults, state
from tidemark.operators.ingest import to_silver
from tidemark.plans.catalog import fixture_silver
from tidemark.sources import feed as feeds
from tidemark.sources.tables import read_silver
from tidemark.streaming import ingest as streaming
from tidemark.streaming import progress

from conftest import SF_SMALL


def test_reports_agree_with_what_is_stored(spark, workdir):
    feed, path = os.path.join(workdir, "feed"), os.path.join(workdir, "silver")
    feeds.fixture_feed(spark, SF_SMALL).repartition(3).write.parquet(feed)
    with progress.BatchReports(spark) as reports:
        query = streaming.ingest_available(feeds.file_stream(spark, feed, 1), path)
        reports.wait_for(query)
    assert reports.count(query) == 3
    stored = progress.stamps_by_batch(read_silver(spark, path), progress.sink_log(spark, path))
    row = progress.stamp_check(reports.table(), stored).first()
    assert tuple(row) == (3, 1251, 3, 3, 3)


def test_reports_keep_the_newest(spark, workdir):
    feed, path = os.path.join(workdir, "feed"), os.path.join(workdir, "silver")
    feeds.fixture_feed(spark, SF_SMALL).repartition(3).write.parquet(feed)
    with progress.BatchReports(spark, keep=2) as reports:
        reports.wait_for(streaming.ingest_available(feeds.file_stream(spark, feed, 1), path))
    assert [r["batch_id"] for r in reports.table().orderBy("batch_id").collect()] == [1, 2]


def test_two_stamps_in_a_batch_and_a_clock_that_went_back_show(spark):
    stored = spark.createDataFrame([(0, 5, 10, 10), (1, 5, 11, 12), (2, 5, 9, 9)], "batch_id long, rows long, a long, b long").select(
        "batch_id", "rows", F.timestamp_seconds("a").alias("first_stamp"), F.timestamp_seconds("b").alias("last_stamp"))
    row = progress.stamp_check(stored, stored).first()
    assert (row["batches"], row["one_stamp"], row["later_stamp"], row["as_observed"]) == (3, 2, 2, 3)


def test_delivery_counts_lost_and_repeated(spark):
    fed = spark.createDataFrame([(0, 1), (0, 2), (0, 2), (1, 1), (None, None)], "partition int, offset long")
    landed = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (2, 9)], "kafka_partition int, kafka_event_offset long")
    got = {r[0]: tuple(r)[1:] for r in audit.delivery(fed.where("partition is not null"), landed).collect()}
    assert got == {0: (3, 3, 1, 1), 1: (1, 0, 1, 0), 2: (0, 1, 0, 1)}


def gaps(positions, expected=()):
    out = []
    ends = {p: (first - 1, following) for p, first, following in expected}
    for p in sorted({x[0] for x in positions} | set(ends)):
        at = sorted({o for q, o in positions if q == p} | set(ends.get(p, ())))
        out += [(p, a + 1, b - 1, b - a - 1) for a, b in zip(at, at[1:]) if b - a > 1]
    return out


def test_lost_offsets_match_a_loop_for_any_cuts(spark):
    rng = random.Random(4)
    positions = [(p, o) for p in range(3) for o in range(200) if rng.random() < 0.8] + [(0, 5)] * 7
    frame = spark.createDataFrame([(p, o) for p, o in positions] + [(None, 3), (1, None)], "kafka_partition int, kafka_event_offset long")
    for ranges in (1, 7, 40):
        assert sorted(map(tuple, audit.lost_offsets(frame, ranges=ranges).collect())) == gaps(positions)
    expected = [(0, 0, 205), (1, 0, 200), (2, 0, 200), (7, 4, 6), (8, 3, 3)]
    ends = spark.createDataFrame(expected, "partition int, first long, next long")
    got = sorted(map(tuple, audit.lost_offsets(frame, ends, ranges=7).collect()))
    assert got == gaps(positions, expected) and (7, 4, 5, 2) in got
    assert audit.lost_offsets(frame.limit(0)).count() == 0


def test_lateness_matches_a_loop_with_a_hot_key(spark):
    rng = random.Random(8)
    rows = [(1 if i % 3 else rng.randint(2, 9), rng.randint(0, 500), i) for i in range(300)] + [(None, 4, 1), (None, 2, 2), (3, None, 5), (4, 5, None), (5, 9, 7), (5, 3, 7)]
    want = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        lags = []
        for _, lsn, at in own:
            ahead = max((b for _, b, o in own if None not in (b, o, at) and o < at), default=None)
            if None not in (lsn, ahead) and ahead > lsn:
                lags.append(ahead - lsn)
        want[key] = (len(own), len(lags), max(lags, default=0))
    frame = spark.createDataFrame(rows, "account_id long, source_commit_lsn long, kafka_event_offset long")
    for ranges in (1, 16):
        assert {r[0]: tuple(r)[1:] for r in audit.lateness(frame, ranges=ranges).collect()} == want


def test_field_faults(spark):
    values = ['{"op":"u","after":{"account_id":"7","current_balance":1},"source":{"lsn":1}}', '{"op":5,"after":[1]}', "{bad", None, "{}", "null",
              '{"after":{"account_id":null,"currency":true,"current_balance":"x"},"before":{"account_id":1.5},"source":"s"}']
    records = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset long").withColumn("partition", F.lit(0)).withColumn("timestamp", F.current_timestamp())
    got = {(r[1], r[2]): r[3] for r in faults.field_faults(records).collect()}
    parsed = {r["kafka_event_offset"]: r for r in to_silver(records).collect()}
    assert got.pop((2, "malformed"), "") is None
    assert got[(0, "after.account_id")] == "STRING" and parsed[0]["account_id"] is None and parsed[0]["current_balance"] == 1.0
    assert got[(1, "after")].startswith("ARRAY")
    assert got[(6, "after.current_balance")] == "STRING" and got[(6, "source")] == "STRING" and got[(6, "before.account_id")] == "DECIMAL(2,1)"
    assert not any(k[0] in (3, 4) for k in got)


def test_aggregate_equals_the_window_and_has_none(spark):
    rows = [(None, 1, 1, 0, "UNKNOWN", "a"), (None, None, 9, 0, "UNKNOWN", "b"), (1, 5, 1, 0, "UPDATE", None), (1, 4, 9, 0, "UPDATE", "old"), (2, 3, 3, 0, "UPDATE", "p0"),
            (2, 3, 3, 2, "UPDATE", "p2"), (2, 3, 3, None, "UPDATE", "pn"), (3, 2, 2, 0, "DELETE", "x"), (3, 1, 8, 0, "INSERT", "y"), (4, None, None, None, "INSERT", "z")]
    frame = spark.createDataFrame(rows, "account_id long, source_commit_lsn long, kafka_event_offset long, kafka_partition int, operation_type string, currency string")
    window, aggregate = state.latest_changes(frame), state.latest_by_aggregate(frame)
    assert sorted(map(str, window.collect())) == sorted(map(str, aggregate.collect()))
    silver = fixture_silver(spark, SF_SMALL)
    a, b = state.current_state(silver), state.current_state_by_aggregate(silver)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        b.explain()
    assert "Window" not in out.getvalue() and "partial_max_by" in out.getvalue()


def test_bench_frames_fit_their_types(spark, workdir):
    import bench

    path = os.path.join(workdir, "feed")
    feeds.fixture_feed(spark, SF_SMALL).write.parquet(path)
    n = bench.replicated_feed(feeds.file_batch(spark, path), 100).select(F.max("offset")).first()[0]
    assert n < bench.small_delta(spark, path).select(F.min("offset")).first()[0] < 1 << 63
    q, info = {}, {"feed": 30}
    bench.skewed_gold(spark, workdir, path, q, info)
    assert q["gold_skewed"] > 0
