"""Structured Streaming ingest over a file feed: micro-batches, restart, both triggers."""

import os

from pyspark.sql import functions as F

from tidemark.plans.catalog import SILVER_STABLE
from tidemark.sources import feed as feeds
from tidemark.sources.tables import read_silver
from tidemark.operators.ingest import to_silver
from tidemark.streaming import ingest as streaming

from conftest import SF_SMALL


def _write_feed_parts(spark, path, parts):
    df = feeds.fixture_feed(spark, SF_SMALL).orderBy("offset")
    df.repartition(parts, "offset").write.mode("overwrite").parquet(path)
    return df


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_available_now_in_several_batches_equals_batch(spark, workdir):
    feed_dir = os.path.join(workdir, "feed")
    _write_feed_parts(spark, feed_dir, 4)
    q = streaming.ingest_available(feeds.file_stream(spark, feed_dir, max_files_per_trigger=1), os.path.join(workdir, "silver"))
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) >= 3
    streamed = read_silver(spark, os.path.join(workdir, "silver"))
    batch = to_silver(feeds.file_batch(spark, feed_dir))
    assert streamed.count() == 1251
    assert _same(streamed.select(*SILVER_STABLE), batch.select(*SILVER_STABLE))
    # month partitions on disk
    months = {d for d in os.listdir(os.path.join(workdir, "silver")) if d.startswith("event_month=")}
    assert {"event_month=2023-12", "event_month=2024-01"} <= months


def test_restart_from_checkpoint_processes_only_new_files(spark, workdir):
    feed_dir = os.path.join(workdir, "feed")
    silver = os.path.join(workdir, "silver")
    full = feeds.fixture_feed(spark, SF_SMALL)
    full.where(F.col("offset") < 600).write.parquet(feed_dir)
    streaming.ingest_available(feeds.file_stream(spark, feed_dir), silver)
    first = read_silver(spark, silver).count()
    full.where(F.col("offset") >= 600).write.mode("append").parquet(feed_dir)
    streaming.ingest_available(feeds.file_stream(spark, feed_dir), silver)
    rows = read_silver(spark, silver)
    assert first < 1251 and rows.count() == 1251
    assert rows.select("kafka_partition", "kafka_event_offset").distinct().count() == 1251


def test_stop_mid_backlog_then_resume_is_exactly_once(spark, workdir):
    import time

    feed_dir = os.path.join(workdir, "feed")
    silver = os.path.join(workdir, "silver")
    _write_feed_parts(spark, feed_dir, 6)
    q = streaming.start_ingest(
        feeds.file_stream(spark, feed_dir, max_files_per_trigger=1), silver, mode="stream", interval="1 second"
    )
    deadline = time.time() + 120
    while q.lastProgress is None or q.lastProgress["batchId"] < 1:
        assert time.time() < deadline
        time.sleep(0.2)
    q.stop()  # interrupted with part of the backlog left
    partial = read_silver(spark, silver).count()
    streaming.ingest_available(feeds.file_stream(spark, feed_dir, max_files_per_trigger=1), silver)
    rows = read_silver(spark, silver)
    assert partial < 1251 and rows.count() == 1251
    assert rows.select("kafka_partition", "kafka_event_offset").distinct().count() == 1251


def test_new_checkpoint_over_old_sink_is_refused(spark, workdir):
    import pytest

    feed_dir = os.path.join(workdir, "feed")
    silver = os.path.join(workdir, "silver")
    feeds.fixture_feed(spark, SF_SMALL).write.parquet(feed_dir)
    streaming.ingest_available(feeds.file_stream(spark, feed_dir), silver)
    with pytest.raises(ValueError, match="streaming sink log"):
        streaming.start_ingest(feeds.file_stream(spark, feed_dir), silver, checkpoint=os.path.join(workdir, "other_ckpt"))
    # the paired checkpoint restarts fine and adds nothing new
    streaming.ingest_available(feeds.file_stream(spark, feed_dir), silver)
    assert read_silver(spark, silver).count() == 1251


def test_batch_append_into_stream_sink_is_refused(spark, workdir):
    import pytest

    feed_dir = os.path.join(workdir, "feed")
    silver = os.path.join(workdir, "silver")
    feeds.fixture_feed(spark, SF_SMALL).write.parquet(feed_dir)
    streaming.ingest_available(feeds.file_stream(spark, feed_dir), silver)
    with pytest.raises(ValueError, match="streaming sink"):
        streaming.ingest_batch(feeds.file_batch(spark, feed_dir), silver)


def test_processing_time_trigger(spark, workdir):
    feed_dir = os.path.join(workdir, "feed")
    _write_feed_parts(spark, feed_dir, 2)
    q = streaming.start_ingest(
        feeds.file_stream(spark, feed_dir), os.path.join(workdir, "silver"), mode="stream", interval="1 second"
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_silver(spark, os.path.join(workdir, "silver")).count() == 1251


def test_ingest_is_map_only(spark, capsys):
    to_silver(feeds.fixture_feed(spark, SF_SMALL)).explain("formatted")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Scan parquet" in plan


def test_kafka_options():
    opts = feeds.kafka_options("broker:9092")
    assert opts == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "cdc.public.accounting",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def test_kafka_options_for_backlogs():
    opts = feeds.kafka_options("b:1", max_offsets_per_trigger=1_000_000, min_partitions=64)
    assert opts["maxOffsetsPerTrigger"] == "1000000" and opts["minPartitions"] == "64"


def test_kafka_source_without_connector_says_what_to_do(spark):
    import pytest

    try:
        feeds.kafka_stream(spark, "localhost:1")
    except RuntimeError as exc:
        assert "file_stream" in str(exc)
    else:  # connector present on this runtime: nothing to check
        pytest.skip("Kafka connector available")


def test_missing_silver_reads_empty(spark, workdir):
    df = read_silver(spark, os.path.join(workdir, "nothing-here"))
    assert df.count() == 0 and len(df.columns) == 14
