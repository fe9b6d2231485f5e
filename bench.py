"""Benchmark of the headline operators; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPLICAS (default "10,100": extra runs on the feed redelivered N times; "" to skip).

Every timed step runs a full action: writes, or a ``noop`` write that executes the
whole plan without collecting rows to the driver. Inputs are materialised first
(feed files, silver sink) under the session's shared folder, so steps time the
operator, not the fixture.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import audit, layout, maintenance, mutations, snapshot, state  # noqa: E402
from tidemark.plans import catalog  # noqa: E402
from tidemark.session import build_session, new_work_path  # noqa: E402
from tidemark.sources import feed as feeds  # noqa: E402
from tidemark.sources import tables  # noqa: E402
from tidemark.streaming import ingest as streaming  # noqa: E402

REPLICA_OFFSET_STRIDE = 10**16
LATENCY_DEADLINE_SEC = 120


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(results: dict, name: str, fn):
    """Run ``fn`` as Spark job group ``name`` (so the event log can attribute stages)."""
    from pyspark import SparkContext

    sc = SparkContext.getOrCreate()
    sc.setJobGroup(name, name)
    t0 = time.perf_counter()
    try:
        out = fn()
    finally:
        sc.setJobGroup("other", "other")
    results[name] = round(time.perf_counter() - t0, 3)
    return out


def event_log_metrics(log_dir: str) -> dict:
    """Per job group: records read, shuffle records/bytes written, from the event log."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    paths = sorted(
        os.path.join(d, f) for d, _, files in os.walk(log_dir) for f in files if f.startswith(("events_", "local-"))
    )
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "other")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    g = out.setdefault(stage_group.get(ev.get("Stage ID"), "other"), {
                        "input_records": 0, "shuffle_records": 0, "shuffle_bytes": 0, "tasks": 0,
                        "max_task_shuffle_read_records": 0})
                    g["tasks"] += 1
                    g["input_records"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    sw = m.get("Shuffle Write Metrics") or {}
                    g["shuffle_records"] += sw.get("Shuffle Records Written", 0)
                    g["shuffle_bytes"] += sw.get("Shuffle Bytes Written", 0)
                    sr = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    g["max_task_shuffle_read_records"] = max(g["max_task_shuffle_read_records"], sr)
    return out


def replicated_feed(feed, copies: int):
    """The feed redelivered ``copies`` times (same changes, new offsets)."""
    rep = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_rep")
    return feed.select("*", rep).select(
        "value",
        (F.col("offset") + F.col("_rep") * F.lit(REPLICA_OFFSET_STRIDE)).alias("offset"),
        "partition",
        "timestamp",
    )


def bench_feed(spark, feed_dir, q: dict, rows: dict, suffix: str = "") -> None:
    root = os.path.dirname(feed_dir)
    silver_batch = root + "/silver_batch"
    silver_stream = root + "/silver"
    n = rows["feed"]

    timed(q, f"ingest_batch{suffix}", lambda: streaming.ingest_batch(feeds.file_batch(spark, feed_dir), silver_batch))
    timed(q, f"ingest_stream{suffix}", lambda: streaming.ingest_available(feeds.file_stream(spark, feed_dir), silver_stream))
    rows[f"ingest_batch_rows_per_s{suffix}"] = round(n / max(q[f"ingest_batch{suffix}"], 1e-9))
    rows[f"ingest_stream_rows_per_s{suffix}"] = round(n / max(q[f"ingest_stream{suffix}"], 1e-9))

    silver = tables.read_silver(spark, silver_stream)
    timed(q, f"gold_current{suffix}", lambda: run(state.current_state(silver)))
    timed(q, f"compaction{suffix}", lambda: maintenance.compact(spark, silver, silver_stream))
    visible = maintenance.visible_rows(spark, tables.read_silver(spark, silver_stream), silver_stream)
    timed(q, f"gold_after_compaction{suffix}", lambda: run(state.current_state(visible)))
    timed(q, f"visible_rows{suffix}", lambda: run(visible))
    timed(q, f"layout{suffix}", lambda: layout.arrange(spark, silver, silver_stream))
    timed(q, f"visible_arranged{suffix}", lambda: run(layout.visible_rows(spark, silver, silver_stream)))
    timed(q, f"gold_by_aggregate{suffix}", lambda: run(state.current_state_by_aggregate(silver)))

    # Incremental state on the batch table: snapshot, a small new arrival, then gold
    # from snapshot + new files only, next to the full re-ranking of all history.
    timed(q, f"state_snapshot{suffix}", lambda: snapshot.write_snapshot(spark, silver_batch))
    streaming.ingest_batch(small_delta(spark, feed_dir), silver_batch)
    timed(q, f"gold_full{suffix}", lambda: run(state.current_state(tables.read_silver(spark, silver_batch))))
    timed(q, f"gold_incremental{suffix}", lambda: run(snapshot.current_state_incremental(spark, silver_batch)))


def small_delta(spark, feed_dir: str, fraction_every: int = 100):
    """About 1% of the feed redelivered later (new offsets): a new arrival."""
    return feeds.file_batch(spark, feed_dir).where(F.pmod(F.col("offset"), F.lit(fraction_every)) == 0).withColumn(
        "offset", F.col("offset") + F.lit(REPLICA_OFFSET_STRIDE * 200)
    )


def change_latency(spark, root: str, feed_dir: str, q: dict) -> None:
    """A running stream (1 s trigger) over the feed directory: time from one new
    change file landing to the change being visible in silver, then in gold."""
    silver_path = root + "/latency/silver"
    stream_feed = root + "/latency/feed"
    feeds.file_batch(spark, feed_dir).write.parquet(stream_feed)
    query = streaming.start_ingest(feeds.file_stream(spark, stream_feed), silver_path, mode="stream", interval="1 second")
    try:
        query.processAllAvailable()
        before = tables.read_silver(spark, silver_path).count()
        change = spark.createDataFrame(
            [(9_999_999_999, 999_999_999_999, "u", "2024-02-01 00:00:00", 123.45, 999_999_999_999, False)],
            "account_id long, lsn long, op string, ts string, value double, off long, junk boolean",
        )
        t0 = time.perf_counter()
        feeds.envelope_records(change).write.mode("append").parquet(stream_feed)
        while tables.read_silver(spark, silver_path).count() == before:
            if time.perf_counter() - t0 > LATENCY_DEADLINE_SEC:
                raise TimeoutError("change did not reach silver")
            time.sleep(0.1)
        q["latency_change_to_silver"] = round(time.perf_counter() - t0, 3)
        gold = state.lookup(state.current_state(tables.read_silver(spark, silver_path)), 9_999_999_999).first()
        q["latency_change_to_gold"] = round(time.perf_counter() - t0, 3)
        assert gold is not None and gold["current_balance"] == 123.45
    finally:
        query.stop()


def skewed_gold(spark, root: str, feed_dir: str, q: dict, info: dict) -> None:
    """One account's change redelivered until it holds a third of all rows: gold over
    that table. The event log shows what the hot key costs the shuffle."""
    base = feeds.file_batch(spark, feed_dir)
    n = info["feed"]
    one = base.where(F.col("offset") == F.lit(1))  # a single change of one account
    hot = one.select(
        "value", "partition", "timestamp", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_i")
    ).select("value", (F.lit(REPLICA_OFFSET_STRIDE * 300) + F.col("_i")).alias("offset"), "partition", "timestamp")
    path = root + "/skewed/silver"
    streaming.ingest_batch(base.unionByName(hot), path)
    silver = tables.read_silver(spark, path)
    timed(q, "gold_skewed", lambda: run(state.current_state(silver)))
    info["skewed_rows"] = n + n // 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    replicas = [int(x) for x in os.environ.get("BENCH_REPLICAS", "10,100").split(",") if x.strip()]
    log_dir = tempfile.mkdtemp(prefix="tidemark-eventlog-")
    spark = build_session(
        "tidemark-bench",
        master=f"local[{cpus}]",
        extra={
            "spark.sql.shuffle.partitions": str(max(cpus, 8)),
            "spark.driver.memory": "16g",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": "file://" + log_dir,
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    q: dict[str, float] = {}
    info: dict[str, int] = {"feed": 0}
    error = None
    try:
        run_steps(spark, sf_dir, replicas, q, info)
    except Exception as exc:  # still report what was measured
        error = f"{type(exc).__name__}: {str(exc)[:300]}"
    finally:
        spark.stop()
    metrics = event_log_metrics(log_dir)
    shuffle = {k: v for k, v in metrics.items() if k in ("gold_current", "gold_current_x10", "gold_current_x100", "gold_skewed",
                                                        "compaction", "gold_incremental", "gold_incremental_x100",
                                                        "mutations", "mutations_hot", "event_mix", "ingest_batch")}
    headline = ["ingest_batch", "ingest_stream", "gold_current", "compaction", "gold_after_compaction",
                "gold_lookup", "event_mix", "mutations", "delta_fold", "reconcile"]
    total = round(sum(q.get(h, 0.0) for h in headline), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": q,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "feed_rows": info["feed"],
        "throughput": {k: v for k, v in info.items() if k != "feed"},
        "cpus": cpus,
        "reference": {
            "micro_batch_interval_sec": 10,
            "change_to_silver_expected_sec": 10,
            "admin_job_expected_sec": [10, 30],
            "design_target_rows_per_s": 579,
        },
        "vs_reference": {
            "change_to_silver_sec": q.get("latency_change_to_silver"),
            "change_to_gold_sec": q.get("latency_change_to_gold"),
            "admin_jobs_sec": {"gold": q.get("gold_current"), "compaction": q.get("compaction")},
            "ingest_rows_per_s_best": max([v for k, v in info.items() if k.startswith("ingest_")] or [0]),
        },
        "event_log": shuffle,
    }
    if error:
        out["error"] = error
    print(json.dumps(out))


def run_steps(spark, sf_dir: str, replicas: list[int], q: dict, info: dict) -> None:
    root = new_work_path(spark, "bench")

    # Inputs: the change feed as files (the broker stand-in).
    feed_dir = root + "/base/feed"
    timed(q, "feed_build", lambda: feeds.fixture_feed(spark, sf_dir).write.parquet(feed_dir))
    info["feed"] = feeds.file_batch(spark, feed_dir).count()
    bench_feed(spark, feed_dir, q, info)

    silver = tables.read_silver(spark, root + "/base/silver")
    gold = state.current_state(silver)
    timed(q, "gold_lookup", lambda: run(state.lookup(gold, catalog.LOOKUP_ACCOUNT)))
    timed(q, "event_mix", lambda: run(audit.event_mix(silver)))
    timed(q, "key_stats", lambda: run(audit.key_stats(silver)))
    timed(q, "silver_newest", lambda: run(audit.newest(silver, 100)))
    reqs = catalog.mutation_requests(spark, sf_dir)
    deltas = catalog.delta_requests(spark, sf_dir)
    timed(q, "mutations", lambda: run(mutations.judge_mutations(reqs, gold)))
    timed(q, "delta_fold", lambda: run(mutations.delta_fold(deltas, gold)))
    # One key holds a third of the requests, and positions have wide gaps.
    def hot(batch):
        return batch.withColumns({"account_id": F.when(F.col("seq") % 3 == 0, F.lit(7)).otherwise(F.col("account_id")),
                                  "seq": F.col("seq") * 10_000_000})

    timed(q, "mutations_hot", lambda: run(mutations.judge_mutations(hot(reqs), gold)))
    timed(q, "delta_fold_hot", lambda: run(mutations.delta_fold(hot(deltas), gold)))
    source = tables.source_from_changes(feeds.fixture_changes(spark, sf_dir))
    timed(q, "reconcile", lambda: run(audit.reconcile(source, gold)))

    change_latency(spark, root, feed_dir, q)
    skewed_gold(spark, root, feed_dir, q, info)

    for k in replicas:
        rdir = root + f"/x{k}/feed"
        timed(q, f"feed_build_x{k}", lambda: replicated_feed(feeds.file_batch(spark, feed_dir), k).write.parquet(rdir))
        info_k = {"feed": info["feed"] * k}
        bench_feed(spark, rdir, q, info_k, suffix=f"_x{k}")
        info.update({key: v for key, v in info_k.items() if key != "feed"})


if __name__ == "__main__":
    main()
