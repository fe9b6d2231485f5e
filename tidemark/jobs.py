"""Command-line jobs over one table root (see :class:`tidemark.table.ChangeTable`).

    python -m tidemark.jobs ingest   --root R --feed-path DIR [--mode once|stream]
    python -m tidemark.jobs ingest   --root R --kafka-bootstrap host:9092 [--mode stream]
    python -m tidemark.jobs gold     --root R           # register views, show gold by key (50)
    python -m tidemark.jobs compact  --root R           # counts before/after, last 5 history rows
    python -m tidemark.jobs report   --root R           # total events, event mix, gold
    python -m tidemark.jobs snapshot --root R           # next per-key state snapshot
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from . import schemas
from .operators import audit
from .session import build_session
from .sources import feed as feeds
from .table import ChangeTable

SHOW_GOLD = 50
SHOW_MIX = 200


def _table(args) -> ChangeTable:
    spark = build_session(f"tidemark-{args.job}")
    spark.sparkContext.setLogLevel("WARN")
    return ChangeTable(spark, args.root, exact_decimal=args.exact_decimal)


def _say(job: str, **values) -> None:
    """One line of named values per job."""
    print(job, *(f"{name}={value}" for name, value in values.items()))


def run_ingest(args) -> int:
    t = _table(args)
    if args.feed_path:
        source = feeds.file_stream(t.spark, args.feed_path, args.max_files_per_trigger)
    else:
        source = feeds.kafka_stream(
            t.spark,
            args.kafka_bootstrap,
            args.topic,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
            min_partitions=args.min_partitions,
        )
    t.start_ingest(source, mode=args.mode).awaitTermination()
    return 0


def run_gold(args) -> int:
    t = _table(args)
    t.register_views()
    _say("gold", views=f"{schemas.SILVER_VIEW},{schemas.GOLD_VIEW}", shown=SHOW_GOLD)
    t.spark.table(schemas.GOLD_VIEW).orderBy(t.spec.key).show(SHOW_GOLD, truncate=False)
    return 0


def run_compact(args) -> int:
    t = _table(args)
    run = t.compact()
    _say("compact", **run)
    t.history(5).show(truncate=False)
    return 0


def run_report(args) -> int:
    t = _table(args)
    silver = t.visible()
    total = silver.agg(F.count(F.lit(1)).alias("c")).first()["c"]
    _say("report", visible_rows=total)
    audit.event_mix(silver).show(SHOW_MIX, truncate=False)
    t.current().orderBy(t.spec.key).show(SHOW_GOLD, truncate=False)
    return 0


def run_snapshot(args) -> int:
    t = _table(args)
    _say("snapshot", **t.snapshot())
    return 0


JOBS = {"ingest": run_ingest, "gold": run_gold, "compact": run_compact, "report": run_report, "snapshot": run_snapshot}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="change-feed table jobs")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--root", required=True, help="table root on shared storage")
    parser.add_argument("--exact-decimal", action="store_true")
    parser.add_argument("--mode", choices=["once", "stream"], default="once")
    parser.add_argument("--feed-path")
    parser.add_argument("--kafka-bootstrap")
    parser.add_argument("--topic", default=feeds.KAFKA_TOPIC)
    parser.add_argument("--max-files-per-trigger", type=int)
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--min-partitions", type=int)
    args = parser.parse_args(argv)
    return JOBS[args.job](args)


if __name__ == "__main__":
    sys.exit(main())
