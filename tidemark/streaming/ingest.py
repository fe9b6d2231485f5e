"""Append-only streaming ingest: feed -> silver, never merging on the write path.

The query is stateless (a projection per micro-batch), so it keeps no state store
and its cost per batch is linear in the batch. Exactly-once into the sink comes
from the checkpoint plus the file sink's metadata log; duplicates *in the feed*
are kept on purpose and resolved when state is read.

Run modes: ``once`` drains everything available, in as many micro-batches as
the source limits allow, then stops (``availableNow``); ``stream`` runs fixed
interval micro-batches (10 s by default).

Usage::

    python -m tidemark.streaming.ingest --table-path PATH --feed-path FEED_DIR [--mode once|stream]
    python -m tidemark.streaming.ingest --table-path PATH --kafka-bootstrap host:9092

Never point a new checkpoint at an existing sink directory (the sink would skip
batch ids it believes committed) and never batch-append into the sink directory
(readers go through the sink's log and would not see those files).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import to_silver
from ..session import path_exists
from ..sources import feed as feeds
from .progress import observed

DEFAULT_INTERVAL = "10 seconds"
CHECKPOINT_SUFFIX = "_checkpoint"


def checkpoint_path(table_path: str) -> str:
    """Checkpoint beside (not inside) the sink directory; the pair is reset only together."""
    return table_path.rstrip("/") + CHECKPOINT_SUFFIX


def _exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def start_ingest(
    source: DataFrame,
    table_path: str,
    mode: str = "once",
    checkpoint: str | None = None,
    interval: str = DEFAULT_INTERVAL,
    exact_decimal: bool = False,
    query_name: str | None = None,
    allow_new_checkpoint: bool = False,
    spec=None,
) -> StreamingQuery:
    """Start the feed -> silver query; returns the running query.

    Refuses a *new* checkpoint over a sink that another checkpoint already wrote:
    the sink would silently skip the batch ids its log holds (rows lost without an
    error). Replays go through new feed files, not a checkpoint reset.
    """
    if not source.isStreaming:
        raise ValueError("start_ingest needs a streaming source (readStream)")
    spark = source.sparkSession
    checkpoint = checkpoint or checkpoint_path(table_path)
    if (
        not allow_new_checkpoint
        and _exists(spark, table_path.rstrip("/") + "/_spark_metadata")
        and not _exists(spark, checkpoint)
    ):
        raise ValueError(
            f"{table_path} already holds a streaming sink log but checkpoint {checkpoint} is new; "
            "reset both together or keep the original checkpoint"
        )
    events = observed(to_silver(source, exact_decimal=exact_decimal, spec=spec))
    writer = (
        events.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .partitionBy("event_month")
    )
    if query_name:
        writer = writer.queryName(query_name)
    if mode == "once":
        writer = writer.trigger(availableNow=True)
    elif mode == "stream":
        writer = writer.trigger(processingTime=interval)
    else:
        raise ValueError(f"unknown mode {mode!r}: use 'once' or 'stream'")
    return writer.start(table_path)


def ingest_available(source: DataFrame, table_path: str, **kwargs) -> StreamingQuery:
    """Drain everything available (``availableNow``) and wait for the stop."""
    query = start_ingest(source, table_path, mode="once", **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def ingest_batch(feed: DataFrame, table_path: str, exact_decimal: bool = False, spec=None, sort_by_key: bool = False) -> int:
    """Backfill a static feed into a *batch* silver directory (not a streaming sink's).

    No shuffle. ``sort_by_key`` sorts each task's rows by month and key, so that Parquet row-group
    statistics on the key are narrow and a pushed-down key lookup can skip row groups; the rows
    are sorted in full width for it, raw JSON included. Returns the number of rows appended.
    """
    if _exists(feed.sparkSession, table_path.rstrip("/") + "/_spark_metadata"):
        # Readers of a streaming sink go through its log: appended files would be invisible.
        raise ValueError(f"{table_path} is a streaming sink; backfill into a sibling table and union")
    parsed = to_silver(feed, exact_decimal=exact_decimal, spec=spec)
    key = (spec.key if spec is not None else "account_id")
    rows = parsed.sortWithinPartitions("event_month", key) if sort_by_key else parsed
    appended = Observation("ingest-batch")  # counted inside the write job
    rows.observe(appended, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy(
        "event_month"
    ).parquet(table_path)
    return int(appended.get["rows"])


def main(argv: list[str] | None = None) -> int:
    from ..session import build_session

    parser = argparse.ArgumentParser(description="Append-only change-feed ingest")
    parser.add_argument("--mode", choices=["once", "stream"], default="once")
    parser.add_argument("--table-path", required=True)
    parser.add_argument("--checkpoint")
    parser.add_argument("--feed-path", help="directory of Parquet feed records (instead of Kafka)")
    parser.add_argument("--kafka-bootstrap")
    parser.add_argument("--topic", default=feeds.KAFKA_TOPIC)
    parser.add_argument("--max-files-per-trigger", type=int)
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--exact-decimal", action="store_true")
    args = parser.parse_args(argv)

    spark: SparkSession = build_session("tidemark-ingest")
    if args.feed_path:
        source = feeds.file_stream(spark, args.feed_path, args.max_files_per_trigger)
    else:
        source = feeds.kafka_stream(
            spark,
            args.kafka_bootstrap,
            args.topic,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
            min_partitions=args.min_partitions,
        )
    query = start_ingest(
        source, args.table_path, mode=args.mode, checkpoint=args.checkpoint, exact_decimal=args.exact_decimal
    )
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
