"""Soft invalidation: sidecar, visible silver, history; gold never moves."""

import os

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import audit, maintenance, state
from tidemark.plans.catalog import fixture_silver
from tidemark.sources import feed as feeds
from tidemark.sources.tables import read_silver
from tidemark.streaming import ingest as streaming

from conftest import SF_SMALL


def _table(spark, workdir):
    path = os.path.join(workdir, "silver")
    assert streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL), path) == 1251
    return path


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_compaction_counts_and_gold_unchanged(spark, workdir):
    path = _table(spark, workdir)
    silver = read_silver(spark, path)
    gold_before = state.current_state(silver)
    run = maintenance.compact(spark, silver, path)
    assert run == {"version": 0, "before": 1251, "invalidated": 1096, "after": 155}
    vis = maintenance.visible_rows(spark, read_silver(spark, path), path)
    assert vis.count() == 155
    assert _same(state.current_state(vis), gold_before)
    assert gold_before.count() == 148


def test_second_run_invalidates_nothing_and_history(spark, workdir):
    path = _table(spark, workdir)
    maintenance.compact(spark, read_silver(spark, path), path)
    again = maintenance.compact(spark, read_silver(spark, path), path)
    assert again["invalidated"] == 0 and again["version"] == 1
    hist = maintenance.recent_history(spark, path).collect()
    assert [h["version"] for h in hist] == [1, 0]
    assert hist[1]["metrics"]["numDeletedRows"] == "1096"
    assert hist[0]["operation"] == "SOFT DELETE"
    assert maintenance.read_kept(spark, path).agg({"_copies": "sum"}).first()[0] == 155


def test_copy_arriving_after_run_stays_visible_until_next_run(spark, workdir):
    path = _table(spark, workdir)
    maintenance.compact(spark, read_silver(spark, path), path)
    # A late redelivery of an old (superseded) change arrives after the run.
    late = feeds.fixture_feed(spark, SF_SMALL).where(F.col("offset") == 3).withColumn("offset", F.lit(9_000_000_000))
    streaming.ingest_batch(late, path)
    vis = maintenance.visible_rows(spark, read_silver(spark, path), path)
    assert vis.count() == 156
    assert maintenance.compact(spark, read_silver(spark, path), path)["invalidated"] == 1


def test_superseded_equals_not_in_form(spark, workdir):
    path = _table(spark, workdir)
    silver = read_silver(spark, path)
    silver.createOrReplaceTempView("mt_silver")
    not_in = spark.sql(
        """SELECT kafka_partition, kafka_event_offset, ingested_at FROM mt_silver WHERE surrogate_key NOT IN (
             SELECT surrogate_key FROM (
               SELECT surrogate_key, ROW_NUMBER() OVER (PARTITION BY account_id
                 ORDER BY source_commit_lsn DESC, kafka_event_offset DESC) AS rn FROM mt_silver) r
             WHERE rn = 1)"""
    )
    anti = maintenance.superseded(silver).select(*schemas.ROW_IDENTITY)
    assert _same(not_in, anti)


def test_anti_join_not_null_aware(spark, workdir, capsys):
    path = _table(spark, workdir)
    maintenance.superseded(read_silver(spark, path)).explain("formatted")
    plan = capsys.readouterr().out
    assert "LeftAnti" in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_health_counts(spark, workdir):
    path = _table(spark, workdir)
    row = audit.health_counts_at(spark, path).first()
    assert (row["silver_table_exists"], row["silver_count"], row["gold_count"]) == (True, 1251, 148)
    missing = audit.health_counts_at(spark, os.path.join(workdir, "absent")).first()
    assert (missing["silver_table_exists"], missing["silver_count"], missing["gold_count"]) == (False, None, None)


def test_newest_preview_and_side_by_side(spark, workdir):
    path = _table(spark, workdir)
    silver = read_silver(spark, path)
    prev = audit.newest(silver, 10)
    assert prev.columns == schemas.PREVIEW_COLUMNS and prev.count() == 10
    views = audit.silver_vs_gold(silver)
    assert views["total"].first()["total_events"] == 1251
    assert views["gold"].count() == 148


def test_hot_surrogate_key_is_split_by_aqe(spark, workdir, capsys):
    """One change redelivered so often that it holds a third of the rows: the anti
    join's hot partition is split (AQE skew join), and the answer is unchanged."""
    silver = fixture_silver(spark, SF_SMALL)
    cols = [c for c in silver.columns if c != "kafka_event_offset"]
    hot = (
        silver.where("account_id = 42 AND source_commit_lsn = 0")
        .withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(650))))
        .select(*cols, (F.lit(9_000_000_000) + F.col("r")).alias("kafka_event_offset"))
        .select(*silver.columns)
    )
    path = os.path.join(workdir, "skewed")
    silver.unionByName(hot).write.partitionBy("event_month").parquet(path)
    skewed = read_silver(spark, path)
    expected = maintenance.superseded(skewed).count()
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = maintenance.superseded(skewed).select(*schemas.ROW_IDENTITY)
        assert len(df.collect()) == expected
        df.explain()
        assert "skew=true" in capsys.readouterr().out
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_replay_of_the_same_offsets_stays_visible(spark, workdir):
    path = _table(spark, workdir)
    run = maintenance.compact(spark, read_silver(spark, path), path)
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL), path)  # every position once more
    vis = maintenance.visible_rows(spark, read_silver(spark, path), path)
    assert vis.count() == run["after"] + 1251
    assert maintenance.compact(spark, read_silver(spark, path), path)["after"] == 2 * run["after"]


def test_begun_runs_keep_their_version(spark, workdir):
    path = os.path.join(workdir, "silver")
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL), path)
    # a run that has begun (or was lost) has its folder, without committed files
    os.makedirs(os.path.join(maintenance.sidecar_path(path), "version=0", "_temporary"))
    run = maintenance.compact(spark, read_silver(spark, path), path)
    assert run["version"] == 1 and run["invalidated"] > 0
    assert [r["version"] for r in maintenance.read_history(spark, path).collect()] == [1]
    assert maintenance.visible_rows(spark, read_silver(spark, path), path).count() == run["after"]


def _arrival(spark, silver, minute):
    return silver.withColumn("ingested_at", F.lit(f"2024-05-01 00:{minute:02d}:00").cast("timestamp"))


def test_backfill_stamped_before_the_cutoff_is_seen(spark, workdir):
    # a backfill that began before a run and ends after it has stamps below the run's cut-off
    silver, path = fixture_silver(spark, SF_SMALL), os.path.join(workdir, "silver")
    main, late = silver.where("kafka_event_offset % 2 = 0"), silver.where("kafka_event_offset % 2 <> 0")
    none = late.limit(0)
    _arrival(spark, main, 10).write.parquet(path)
    run = maintenance.compact(spark, read_silver(spark, path), path, more=none)
    more = _arrival(spark, late, 5)
    vis = maintenance.visible_rows(spark, read_silver(spark, path), path, more)
    assert vis.count() == run["after"] + late.count()
    assert _same(state.current_state(vis), state.current_state(silver))
    again = maintenance.compact(spark, read_silver(spark, path), path, more=more)
    assert again["before"] == vis.count()
    vis = maintenance.visible_rows(spark, read_silver(spark, path), path, more)
    assert vis.count() == again["after"] and _same(state.current_state(vis), state.current_state(silver))
    assert maintenance.compact(spark, read_silver(spark, path), path, more=more)["invalidated"] == 0


def test_hidden_rows_stay_hidden_when_their_surrogate_key_wins_later(spark, workdir):
    # (5, no position) and (no key, 5) share a surrogate key: the first is hidden, the second wins
    row, path = fixture_silver(spark, SF_SMALL).limit(1), os.path.join(workdir, "silver")

    def change(key, lsn, minute):
        cast = {"account_id": F.lit(key).cast("long"), "source_commit_lsn": F.lit(lsn).cast("long"),
                "surrogate_key": F.xxhash64(F.concat_ws("|", F.lit(key).cast("string"), F.lit(lsn).cast("string")))}
        return _arrival(spark, row.withColumns(cast), minute)

    change(5, None, 1).union(change(5, 3, 1)).write.parquet(path)
    assert maintenance.compact(spark, read_silver(spark, path), path)["after"] == 1
    change(None, 5, 2).write.mode("append").parquet(path)
    assert maintenance.compact(spark, read_silver(spark, path), path) == {"version": 1, "before": 2, "invalidated": 0, "after": 2}
    seen = maintenance.visible_rows(spark, read_silver(spark, path), path).select("account_id", "source_commit_lsn").collect()
    assert sorted(map(tuple, seen), key=str) == [(5, 3), (None, 5)]
