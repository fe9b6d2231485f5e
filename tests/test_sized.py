"""The sink with file-size control: same rows as the plain sink, files within the stated range."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog
from tidemark.plans.catalog import SILVER_STABLE
from tidemark.sources import feed as feeds
from tidemark.sources.tables import read_silver
from tidemark.streaming import ingest as streaming
from tidemark.streaming import sized
from tidemark.table import ChangeTable

from conftest import SF_SMALL

TARGET = 32 << 10


def same(a, b):
    a, b = a.select(*SILVER_STABLE), b.select(*SILVER_STABLE)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fifty_micro_batches_against_the_plain_sink(spark, workdir):
    feed, path, plain = (os.path.join(workdir, x) for x in ("feed", "silver", "plain"))
    feeds.fixture_feed(spark, SF_SMALL).repartition(50).write.parquet(feed)
    sized.start_sized_ingest(feeds.file_stream(spark, feed, 1), path, target_bytes=TARGET).awaitTermination()
    assert len(sized.live_parts(spark, path)) == 50
    small = sized.file_sizes(spark, path).count()
    streaming.ingest_available(feeds.file_stream(spark, feed), plain)
    assert same(read_silver(spark, path), read_silver(spark, plain))

    before = sized.bins(sized.file_sizes(spark, path), TARGET)
    # by the bytes that go in; only a month's last bin may hold less
    filled = before.groupBy("event_month", "_bin").agg(F.sum("bytes").alias("bytes")).collect()
    for month in {r["event_month"] for r in filled}:
        own = sorted((r["_bin"], r["bytes"]) for r in filled if r["event_month"] == month)
        assert all(TARGET * (1 - sized.SMALL) <= b <= TARGET * (1 + sized.SMALL) for _, b in own[:-1]) and own[-1][1] <= TARGET * (1 + sized.SMALL)
    assert sorted(r["_bin"] for r in filled) == list(range(len(filled)))

    assert sized.pack(spark, path, TARGET) == {"merged": 50, "parts": 1}
    files = sized.file_sizes(spark, path)
    assert files.count() == len(filled) < small / 3
    assert files.agg(F.max("bytes")).first()[0] <= TARGET * (1 + sized.SMALL)
    assert same(read_silver(spark, path), read_silver(spark, plain))
    assert sized.pack(spark, path, TARGET)["merged"] == 0


def test_a_batch_that_comes_again_lands_once(spark, workdir):
    path = os.path.join(workdir, "silver")
    from tidemark.operators.ingest import to_silver

    rows = to_silver(feeds.fixture_feed(spark, SF_SMALL))
    # rows of an attempt that failed before its log entry
    rows.limit(5).write.partitionBy("event_month").parquet(path + "/parts/part=batch-0")
    assert read_silver(spark, path).count() == 0 or not sized.is_sized(spark, path)
    assert sized.write_batch(rows, 0, path)
    assert not sized.write_batch(rows, 0, path)
    assert read_silver(spark, path).count() == 1251
    assert sized.write_batch(rows.limit(10), 1, path)
    sized.pack(spark, path)
    assert not sized.write_batch(rows, 1, path)  # committed, then packed
    assert read_silver(spark, path).count() == 1261


def test_tiers_leave_large_old_parts_alone(spark, workdir, monkeypatch):
    from tidemark.operators.ingest import to_silver

    path = os.path.join(workdir, "silver")
    rows = to_silver(feeds.fixture_feed(spark, SF_SMALL))
    sized.write_batch(rows, 0, path)
    for i in (1, 2, 3):
        sized.write_batch(rows.limit(3), i, path)
    monkeypatch.setattr(sized, "TIER", 1)
    assert sized.pack(spark, path, target_bytes=100) == {"merged": 3, "parts": 2}
    assert [p.name for p in sized.live_parts(spark, path)] == ["batch-0", "pack-1-3"]
    sized.write_batch(rows.limit(3), 4, path)
    monkeypatch.setattr(sized, "TIER", 100)
    assert sized.pack(spark, path)["parts"] == 1
    # what the first pack replaced is gone, what the second replaced is still there for its readers
    assert not os.path.exists(path + "/parts/part=batch-2") and os.path.exists(path + "/parts/part=pack-1-3")
    assert read_silver(spark, path).count() == 1251 + 12


def test_large_files_are_bins_of_their_own(spark):
    files = spark.createDataFrame([("p", "m", f"f{i}", b) for i, b in enumerate((10, 90, 40, 40, 40, 200, 10))] + [("p", "n", "g", 500)],
                                  "part string, event_month string, file string, bytes long")
    got = {r["event_month"] + r["file"]: r["_bin"] for r in sized.bins(files, 100).collect()}
    assert got["mf0"] == got["mf2"] == got["mf3"] == got["mf4"] and got["mf6"] != got["mf0"]
    assert len(set(got.values())) == 5 and sorted(set(got.values())) == list(range(5))


def test_restart_and_refused_checkpoint(spark, workdir):
    feed, path = os.path.join(workdir, "feed"), os.path.join(workdir, "silver")
    records = feeds.fixture_feed(spark, SF_SMALL)
    records.where("offset % 2 = 0").write.parquet(feed)
    sized.start_sized_ingest(feeds.file_stream(spark, feed), path).awaitTermination()
    records.where("offset % 2 <> 0").write.mode("append").parquet(feed)
    sized.start_sized_ingest(feeds.file_stream(spark, feed), path).awaitTermination()
    assert read_silver(spark, path).count() == 1251
    with pytest.raises(ValueError, match="checkpoint"):
        sized.start_sized_ingest(feeds.file_stream(spark, feed), path, checkpoint=os.path.join(workdir, "other"))
    with pytest.raises(ValueError, match="mode"):
        sized.start_sized_ingest(feeds.file_stream(spark, feed), path, mode="often")
    with pytest.raises(ValueError, match="streaming"):
        sized.start_sized_ingest(feeds.file_batch(spark, feed), path)


def test_change_table_over_a_sized_sink(spark, workdir):
    t = ChangeTable(spark, workdir, target_file_bytes=TARGET)
    feed = os.path.join(workdir, "feed")
    feeds.fixture_feed(spark, SF_SMALL).repartition(4).write.parquet(feed)
    t.ingest_available(feeds.file_stream(spark, feed, 1))
    gold = t.gold().collect()
    assert len(gold) == 148
    t.snapshot()
    t.compact()
    assert t.visible().count() == 155
    assert t.pack()["merged"] == 4
    assert t.visible().count() == 155 and sorted(t.gold().collect(), key=str) == sorted(gold, key=str)
    assert t.gold_incremental().count() == 148


def tables_of_their_own(spark, path, events=1200):
    """events over January and February, and customers, of made-up rows."""
    spark.range(events).selectExpr(
        "id AS event_id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS ts", "id % 50 AS user_id",
        "CASE WHEN id % 9 = 0 THEN 'error' WHEN id % 5 = 0 THEN 'signup' ELSE 'click' END AS event_type", "id / 4D AS value").write.parquet(path + "/events.parquet")
    spark.range(50).selectExpr("id AS c_custkey", "id * 1.5D AS c_acctbal").write.parquet(path + "/customer.parquet")
    return path


def test_a_large_micro_batch_is_read_by_several_tasks(spark, workdir, monkeypatch):
    sf, root = tables_of_their_own(spark, workdir + "/sf"), workdir + "/work"
    plain = catalog.sized_sink(spark, sf).collect()
    monkeypatch.setattr(feeds, "FILE_RECORDS", 100)
    monkeypatch.setattr(catalog, "new_work_path", lambda spark, name: root)
    assert sorted(catalog.sized_sink(spark, sf).collect(), key=str) == sorted(plain, key=str)
    assert len(plain) == 1200 + 120 + 50 + 1
    assert sorted(p.name for p in sized._logged(spark, root + "/silver")) == [*(f"batch-{i}" for i in range(catalog.SIZED_BATCHES)), "pack-0-5"]
    files = feeds.file_batch(spark, root + "/feed").groupBy(F.input_file_name()).count().collect()
    assert len(files) == 3 * catalog.SIZED_BATCHES and max(r["count"] for r in files) <= 100


def test_streams_over_several_files_a_micro_batch(spark, workdir, monkeypatch):
    sf = tables_of_their_own(spark, workdir + "/sf")
    monkeypatch.setattr(feeds, "FILE_RECORDS", 50)
    cut = spark.sql(f"SELECT timestamp'{catalog.SNAPSHOT_CUT}'").first()[0]
    early = spark.read.parquet(sf + "/events.parquet").where(F.col("ts") < F.lit(cut)).count()
    assert 150 < early < 1050  # both runs have several files a micro-batch
    dealt, write = [], feeds.write_files
    monkeypatch.setattr(feeds, "write_files", lambda records, path, batches, each, **kw: dealt.append(each) or write(records, path, batches, each, **kw))
    assert tuple(catalog.ingest_stamps(spark, sf).first()) == (6, 1371, 6, 6, 6)
    delivered = catalog.restart_delivery(spark, sf).collect()
    assert sum(r["landed"] for r in delivered) == 1371 and {(r["lost"], r["repeated"], r["runs"], r["batches"]) for r in delivered} == {(0, 0, 2, 6)}
    assert catalog.stream_vs_batch(spark, sf).count() == 1371
    assert len(dealt) == 4 and min(dealt) > 1


def test_a_part_larger_than_the_newest_does_not_end_a_pack(spark, workdir, monkeypatch):
    from tidemark.operators.ingest import to_silver

    path = os.path.join(workdir, "silver")
    rows = to_silver(feeds.fixture_feed(spark, tables_of_their_own(spark, workdir + "/sf", events=5000)))
    one = rows.where("source_commit_lsn = 2 AND kafka_event_offset = 2")
    several = one.unionByName(one.withColumn("event_month", F.lit("2024-02"))).unionByName(one.withColumn("event_month", F.lit("2024-03")))
    # bytes: many, those of one file, of three, of one
    for i, batch in enumerate((rows, one, several, one)):
        sized.write_batch(batch, i, path)
    large = {r["part"]: r["b"] for r in sized.file_sizes(spark, path).groupBy("part").agg(F.sum("bytes").alias("b")).collect()}
    assert large["batch-2"] > 2.5 * large["batch-3"]
    monkeypatch.setattr(sized, "TIER", 2)
    assert sized.pack(spark, path, target_bytes=100) == {"merged": 3, "parts": 2}
    assert [p.name for p in sized.live_parts(spark, path)] == ["batch-0", "pack-1-3"]
    assert read_silver(spark, path).count() == rows.count() + 5
