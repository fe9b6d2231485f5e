"""The bucketed layout of the visible rows: the rows of ``maintenance.visible_rows``, silver not shuffled."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import layout, maintenance
from tidemark.session import path_exists
from tidemark.sources import feed as feeds
from tidemark.sources.tables import read_silver
from tidemark.streaming import ingest as streaming
from tidemark.table import ChangeTable

from conftest import SF_SMALL


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def both(t):
    return t.visible(), maintenance.visible_rows(t.spark, t._stream(), t.silver_path, t._backfills())


@pytest.fixture()
def table(spark, workdir):
    return ChangeTable(spark, workdir)


def test_equal_after_each_step(spark, table):
    records = feeds.fixture_feed(spark, SF_SMALL)
    part = F.pmod("offset", F.lit(4))
    streaming.ingest_batch(records.where(part == 0), table.silver_path)
    table.compact()
    assert table.arrange(3)["buckets"] == 3
    assert same(*both(table))
    streaming.ingest_batch(records.where(part == 1), table.silver_path)  # later rows, no run yet
    assert same(*both(table))
    table.backfill(records.where(part == 2))
    table.compact()  # a run without a layout of its own
    assert same(*both(table))
    assert table.arrange()["stored"] > 0
    assert same(*both(table))
    table.backfill(records.where(part == 3))
    streaming.ingest_batch(records.where(part == 0), table.silver_path)  # positions that were hidden come again
    assert same(*both(table))
    table.compact()
    table.arrange()
    assert same(*both(table))


def test_no_exchange_above_silver(spark, table):
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL), table.silver_path)
    table.compact()
    table.arrange(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            layout.visible_rows(spark, read_silver(spark, table.silver_path), table.silver_path).explain()
        plan = out.getvalue()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Bucketed: true") == 2 and "SortMergeJoin" in plan
    bucketed = plan[plan.index("SortMergeJoin"):plan.rindex("Bucketed: true")]
    assert "Exchange" not in bucketed


def test_hot_surrogate_key_leaves_the_buckets(spark, workdir):
    path = os.path.join(workdir, "silver")
    junk = spark.range(400).select(F.lit("{bad").alias("value"), (F.col("id") + 10**9).alias("offset"), F.lit(0).alias("partition"),
                                   F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"))
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL).unionByName(junk), path)
    silver = read_silver(spark, path)
    maintenance.compact(spark, silver, path)
    layout.arrange(spark, silver, path, buckets=4)
    hot = spark.read.parquet(layout.layout_path(path) + "/hot")
    assert hot.count() >= 400 and hot.select("surrogate_key").distinct().count() == 1
    assert same(layout.visible_rows(spark, silver, path), maintenance.visible_rows(spark, silver, path))
    # hot at the first run, replaced at the second: its rows stay in the hot part and are hidden
    newer = junk.limit(1).withColumn("value", F.lit('{"op":"u","source":{"lsn":7}}')).withColumn("offset", F.lit(2 * 10**9))
    streaming.ingest_batch(newer, path)
    silver = read_silver(spark, path)
    maintenance.compact(spark, silver, path)
    layout.arrange(spark, silver, path)
    assert same(layout.visible_rows(spark, silver, path), maintenance.visible_rows(spark, silver, path))


def test_a_failed_call_leaves_nothing_that_is_read(spark, table):
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL), table.silver_path)
    table.compact()
    table.arrange(4)
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL), table.silver_path)
    table.compact()
    # rows of the next run, without a log entry
    root = layout.layout_path(table.silver_path)
    layout._write_buckets(spark.read.parquet(root + "/rows/run=0").withColumn("_run", F.lit(1).cast("long")), root + "/rows/run=1", 4)
    assert same(*both(table))
    table.arrange()
    assert same(*both(table))


def test_twice_after_one_run_and_before_any(spark, table):
    with pytest.raises(ValueError, match="compact"):
        table.arrange()
    assert table.visible().count() == 0
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL), table.silver_path)
    table.compact()
    assert table.arrange(4)["stored"] == 155
    assert table.arrange(4)["stored"] == 0
    assert table.visible().count() == 155


def test_empty_table_and_old_versions(spark, table):
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL).limit(0), table.silver_path)
    for _ in range(maintenance.KEEP_VERSIONS + 1):
        table.compact()
        table.arrange(2)
    assert table.visible().count() == 0
    root = layout.layout_path(table.silver_path)
    assert not path_exists(spark, f"{root}/kept/run=0") and path_exists(spark, f"{root}/kept/run=3")
