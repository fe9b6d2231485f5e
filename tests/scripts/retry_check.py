"""Run with task retries on and a failure injected into first task attempts; print
whether every result equals the failure-free run. Invoked by test_fault_tolerance."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402

from tidemark.operators import maintenance, mutations, snapshot, state  # noqa: E402
from tidemark.plans import catalog  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources import feed as feeds  # noqa: E402
from tidemark.sources.tables import read_silver  # noqa: E402
from tidemark.streaming import ingest as streaming  # noqa: E402


def flaky(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return True


def main(sf_dir: str) -> None:
    spark = build_session("retry-check", master="local[4,3]", extra={"spark.sql.shuffle.partitions": "4"})
    spark.sparkContext.setLogLevel(os.environ.get("RETRY_LOG", "OFF"))
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retry-ckpt-"))
    fail_once = F.udf(flaky, BooleanType())
    root = tempfile.mkdtemp(prefix="retry-")
    results = {}

    for label, inject in (("clean", False), ("flaky", True)):
        path = f"{root}/{label}/silver"
        records = feeds.fixture_feed(spark, sf_dir)
        if inject:
            records = records.where(fail_once(F.col("offset")))
        streaming.ingest_batch(records, path)
        silver = read_silver(spark, path)
        if inject:
            silver = silver.where(fail_once(F.col("kafka_event_offset")))
        run = maintenance.compact(spark, silver, path)
        side = sorted(tuple(r) for r in maintenance.read_kept(spark, path).select(
            "surrogate_key", "_copies").collect())
        gold = state.current_state(silver)
        reqs = catalog.mutation_requests(spark, sf_dir)
        if inject:
            reqs = reqs.where(fail_once(F.col("seq")))
        judged = mutations.judge_mutations(reqs, gold)
        verdicts = sorted(tuple(r) for r in judged.select("seq", "reason", "op", "current_balance").collect())
        snapshot.write_snapshot(spark, path)
        inc = sorted(tuple(r) for r in snapshot.current_state_incremental(spark, path).collect())
        results[label] = {"run": run, "sidecar": side, "verdicts": verdicts, "gold": inc}

    same = {k: results["clean"][k] == results["flaky"][k] for k in results["clean"]}

    # Streaming ingest with failing tasks inside micro-batches: exactly once in the sink.
    feed_dir, sink = f"{root}/stream/feed", f"{root}/stream/silver"
    feeds.fixture_feed(spark, sf_dir).repartition(4).write.parquet(feed_dir)
    source = feeds.file_stream(spark, feed_dir, max_files_per_trigger=2).where(fail_once(F.col("offset")))
    streaming.ingest_available(source, sink)
    streamed = read_silver(spark, sink)
    same["stream_rows"] = streamed.count() == streamed.select("kafka_partition", "kafka_event_offset").distinct().count()
    same["stream_total"] = streamed.count() == results["clean"]["run"]["before"]

    print(json.dumps({"same": same, "invalidated": results["flaky"]["run"]["invalidated"]}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
