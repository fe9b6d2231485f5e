"""Incremental current state: snapshot + new files == full read-time resolution."""

import json
import os

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import snapshot, state
from tidemark.sources import feed as feeds
from tidemark.sources.tables import read_silver
from tidemark.streaming import ingest as streaming

from conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_snapshot_chain_equals_full_read(spark, workdir):
    path = os.path.join(workdir, "silver")
    records = feeds.fixture_feed(spark, SF_SMALL)
    parts = [F.pmod(F.col("offset"), F.lit(3)) == i for i in range(3)]
    streaming.ingest_batch(records.where(parts[0]), path)
    assert snapshot.write_snapshot(spark, path)["version"] == 0
    streaming.ingest_batch(records.where(parts[1]), path)
    assert snapshot.write_snapshot(spark, path)["version"] == 1
    streaming.ingest_batch(records.where(parts[2]), path)
    full = state.current_state(read_silver(spark, path))
    inc = snapshot.current_state_incremental(spark, path)
    assert full.count() == 148
    assert _same(full, inc)


def test_only_later_arrivals_are_ranked(spark, workdir):
    path = os.path.join(workdir, "silver")
    records = feeds.fixture_feed(spark, SF_SMALL)
    streaming.ingest_batch(records.where(F.col("offset") < 500), path)
    first = snapshot.write_snapshot(spark, path)
    assert first["arrived"] == records.where(F.col("offset") < 500).count()
    streaming.ingest_batch(records.where(F.col("offset") >= 500), path)
    rows, arrived, version, _ = snapshot._state_inputs(spark, path, schemas.SILVER)
    assert version == 0
    assert arrived.count() == records.where(F.col("offset") >= 500).count()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ingested_at" in plan  # pushed to the scan


def test_old_versions_go_and_empty_arrivals_keep_the_cutoff(spark, workdir):
    path = os.path.join(workdir, "silver")
    streaming.ingest_batch(feeds.fixture_feed(spark, SF_SMALL), path)
    for version in range(snapshot.KEEP_VERSIONS + 2):
        done = snapshot.write_snapshot(spark, path)
        assert done["version"] == version and (done["arrived"] > 0) == (version == 0)
    rows = sorted(os.listdir(snapshot.snapshot_path(path) + "/rows"))
    assert len([r for r in rows if r.startswith("version=")]) == snapshot.KEEP_VERSIONS
    assert _same(snapshot.current_state_incremental(spark, path), state.current_state(read_silver(spark, path)))


def _env(op, account, lsn, balance=None):
    image = {"account_id": account, "current_balance": balance, "currency": "USD",
             "transaction_timestamp": "2024-01-01T00:00:00.000000Z", "updated_at": None}
    doc = {"after": None if op == "d" else image, "before": image if op == "d" else None,
           "source": {"lsn": lsn}, "op": op}
    return json.dumps(doc)


def test_tombstone_and_late_change_across_snapshot(spark, workdir):
    path = os.path.join(workdir, "silver")
    first = spark.createDataFrame(
        [(_env("c", 1, 1, 1.0), 1, 1, None), (_env("d", 1, 5), 2, 1, None), (_env("c", 2, 2, 2.0), 3, 2, None)],
        schemas.FEED,
    )
    streaming.ingest_batch(first, path)
    snapshot.write_snapshot(spark, path)
    late = spark.createDataFrame(
        [(_env("u", 1, 3, 3.0), 10, 1, None),   # older than the delete in the snapshot
         (_env("u", 2, 1, 9.0), 11, 2, None),   # older than account 2's snapshot winner
         (_env("u", 2, 4, 4.0), 12, 2, None)],  # newer: wins
        schemas.FEED,
    )
    streaming.ingest_batch(late, path)
    got = {r["account_id"]: r["current_balance"] for r in snapshot.current_state_incremental(spark, path).collect()}
    assert got == {2: 4.0}
    assert _same(snapshot.current_state_incremental(spark, path), state.current_state(read_silver(spark, path)))
