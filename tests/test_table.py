"""The table handle: stream + backfill, gold, compaction, history, snapshots."""

import os

import pytest

from pyspark.sql import functions as F

from tidemark.operators import state
from tidemark.plans.catalog import fixture_silver
from tidemark.sources import feed as feeds
from tidemark.table import ChangeTable

from conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_change_table_end_to_end(spark, workdir):
    t = ChangeTable(spark, os.path.join(workdir, "accounting"))
    records = feeds.fixture_feed(spark, SF_SMALL)
    feed_dir = os.path.join(workdir, "feed")
    records.where(F.col("offset") >= 0).write.parquet(feed_dir)
    t.ingest_available(feeds.file_stream(spark, feed_dir))
    t.backfill(records.where(F.col("offset") < 0))  # the snapshot reads, loaded separately
    assert t.silver().count() == 1251
    expected = state.current_state(fixture_silver(spark, SF_SMALL)).drop("surrogate_key")
    assert _same(t.gold().drop("surrogate_key"), expected)
    run = t.compact()
    assert run["before"] == 1251 and run["after"] == 155
    assert _same(t.gold().drop("surrogate_key"), expected)
    assert _same(t.gold(), state.current_state(t.visible()))
    # a late redelivery of a superseded change after the run: still equal
    t.backfill(records.where(F.col("offset") == 3).withColumn("offset", F.lit(9_000_000_001)))
    assert _same(t.gold(), state.current_state(t.visible()))
    assert t.history().count() == 1
    t.register_views("tt_silver", "tt_gold")
    assert spark.table("tt_gold").count() == 148
    row = t.counts().first()
    assert row["silver_table_exists"] and row["silver_count"] == 156 and row["gold_count"] == 148
    rows = t.preview(10).collect()
    assert len(rows) == 10 and {r["total_events"] for r in rows} == {156}
    t.snapshot()
    gold_before = spark.createDataFrame(t.gold().collect(), t.gold().schema)
    # backfills after the snapshot count, also one with a key's newest change
    assert _same(t.gold_incremental(), t.gold())
    newest = records.where("offset >= 0 AND value LIKE '%\"op\":\"u\"%'").orderBy(F.col("offset").desc()).limit(1)
    t.backfill(newest.withColumns({
        "offset": F.lit(9_000_000_002),
        "value": F.regexp_replace("value", '"lsn":[0-9]+', '"lsn":99000000000')}))
    assert not _same(t.gold(), gold_before)
    assert _same(t.current(), t.gold())


def test_change_table_exact_decimal(spark, workdir):
    t = ChangeTable(spark, os.path.join(workdir, "accounting_dec"), exact_decimal=True)
    feed_dir = os.path.join(workdir, "feed")
    feeds.fixture_feed(spark, SF_SMALL).write.parquet(feed_dir)
    t.ingest_available(feeds.file_stream(spark, feed_dir))
    gold = t.gold()
    assert dict(gold.dtypes)["current_balance"] == "decimal(14,2)"
    assert gold.count() == 148
    assert t.counts().first()["gold_count"] == 148
    t.snapshot()
    assert _same(t.gold_incremental(), gold)


def test_jobs_cli(spark, workdir, capsys):
    from tidemark import jobs

    root = os.path.join(workdir, "cli")
    feed_dir = os.path.join(workdir, "feed")
    feeds.fixture_feed(spark, SF_SMALL).write.parquet(feed_dir)
    assert jobs.main(["ingest", "--root", root, "--feed-path", feed_dir, "--mode", "once"]) == 0
    assert jobs.main(["gold", "--root", root]) == 0
    assert jobs.main(["compact", "--root", root]) == 0
    assert jobs.main(["report", "--root", root]) == 0
    assert jobs.main(["snapshot", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "compact version=0 before=1251 invalidated=1096 after=155" in out
    assert "report visible_rows=155" in out
    spark.sparkContext.setLogLevel("ERROR")


def test_change_table_mutations_use_current_state(spark, workdir):
    from tidemark import schemas as S

    t = ChangeTable(spark, os.path.join(workdir, "acct"))
    feed_dir = os.path.join(workdir, "feed")
    feeds.fixture_feed(spark, SF_SMALL).write.parquet(feed_dir)
    t.ingest_available(feeds.file_stream(spark, feed_dir))
    t.snapshot()
    assert _same(t.current(), t.gold())
    reqs = spark.createDataFrame(
        [(0, "update", 42, 7.0, None), (1, "delete", 42, None, None), (2, "update", 42, 8.0, None),
         (3, "insert", 999999, 1.0, "EUR")],
        S.REQUEST,
    )
    verdicts = {r["seq"]: (r["op"], r["reason"]) for r in t.judge_mutations(reqs).collect()}
    assert verdicts == {0: ("u", None), 1: ("d", None), 2: (None, "not found"), 3: ("c", None)}
    # accepted requests become change envelopes on the same feed, like any other change
    t.mutation_events(reqs, 10_000_000_000, "2024-03-01 00:00:00").write.mode("append").parquet(feed_dir)
    t.ingest_available(feeds.file_stream(spark, feed_dir))
    now = {r["account_id"]: (r["current_balance"], r["currency"]) for r in t.current().collect()}
    assert 42 not in now and now[999999] == (1.0, "EUR")
    assert _same(t.current(), t.gold())


def test_empty_table_operations(spark, workdir):
    t = ChangeTable(spark, os.path.join(workdir, "empty"))
    assert t.snapshot()["arrived"] == 0
    assert t.gold().count() == 0 and t.gold_incremental().count() == 0 and t.current().count() == 0
    assert t.compact() == {"version": 0, "before": 0, "invalidated": 0, "after": 0}
    row = t.counts().first()
    assert (row["silver_table_exists"], row["silver_count"], row["gold_count"]) == (False, None, None)
