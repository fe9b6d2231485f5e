"""Soft invalidation of superseded silver rows, without rewriting data files.

Parquet has no row-level delete, so a run records what stays instead of what goes: next to the
table it writes, per version, the newest change of each key (``winners``), the surrogate keys that
stay with their visible copies (``kept``), and what it has seen: the latest arrival in the stream
sink (the cut-off) and the arrivals of the backfills. Readers see

    visible(silver) = rows that arrived after the newest run
                      + rows that it covered and whose surrogate key it kept.

Selection follows the reference semantics: a visible row is superseded when its
``surrogate_key`` is not the key of any key's newest change (deletes included, so
tombstones survive and a late older change can never resurrect a key).
Redelivered copies of a winner share its surrogate key and therefore survive. Rows that
arrive after a run (also replays of positions that the run hid) stay visible until the next
run. A surrogate key that a run did not keep hides the rows of that time for good: each kept key
carries the run since which it has been kept.

Why the cut-off misses no row: see ``operators.snapshot`` (one stream writes a sink, and stamps
grow). Backfills may overlap each other, so the runs list their arrivals one by one. Rows without a
stamp are never hidden.

Scale notes:
* a run costs keys + new rows: winners are associative, so those of version N+1 come from those of
  version N and the rows after its cut-off; a row covered before is not read again (its row groups
  are skipped by the statistics of ``ingested_at``);
* winners come from a ``row_number() = 1`` window (partial top-1 before the shuffle), copies from a
  count with partial aggregation;
* what is stored grows with keys, not with hidden rows; the last few versions are kept for readers
  that still use them;
* ``superseded`` / ``retained`` are equi-joins, never ``NOT IN``, which would have to broadcast every
  winner key. The key is never NULL (xxhash64), so both forms select the same rows;
* the log entry is written last: a run that failed leaves nothing that readers would use.
"""

from __future__ import annotations

import datetime as _dt
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import path_exists, remove_path, shared_dir
from ..sources.tables import empty
from .snapshot import KEEP_VERSIONS, after
from .state import KEY, ORDER, latest_changes, winners

SIDECAR_DIR = "_invalidated"
HISTORY_DIR = "_history"


def sidecar_path(table_path: str) -> str:
    # A sibling of the silver directory: batch writes never go into a streaming
    # sink's directory (its metadata log would hide them).
    return table_path.rstrip("/") + SIDECAR_DIR


def _version_path(table_path: str, version: int) -> str:
    return f"{sidecar_path(table_path)}/version={version}"


def history_path(table_path: str) -> str:
    return table_path.rstrip("/") + HISTORY_DIR


def _read_or_empty(spark: SparkSession, path: str, schema, reader: str = "parquet") -> DataFrame:
    if not path_exists(spark, path):
        return empty(spark, schema)
    return getattr(spark.read.schema(schema), reader)(path)


class Run(NamedTuple):
    """The newest finished run: its version, the latest arrival in the stream sink that it covers
    (microseconds; None if there was none), and the folder of its tables."""

    version: int
    cutoff: int | None
    path: str


def newest_run(spark: SparkSession, table_path: str) -> Run | None:
    log = sidecar_path(table_path) + "/log"
    if not path_exists(spark, log):
        return None
    found = spark.read.schema(schemas.SNAPSHOT_LOG).parquet(log).agg(F.max_by(F.struct("version", "cutoff"), "version").alias("m")).first()["m"]
    return Run(found["version"], found["cutoff"], _version_path(table_path, found["version"]))


def read_kept(spark: SparkSession, table_path: str) -> DataFrame:
    """Surrogate keys that the newest run kept, with their visible copies (empty before any run)."""
    run = newest_run(spark, table_path)
    return empty(spark, schemas.KEPT) if run is None else spark.read.schema(schemas.KEPT).parquet(run.path + "/kept")


def backfill_arrivals(spark: SparkSession, run: Run | None) -> DataFrame:
    """Arrivals of the backfills that runs up to ``run`` have covered."""
    return empty(spark, schemas.ARRIVALS) if run is None else spark.read.schema(schemas.ARRIVALS).parquet(run.path + "/arrivals")


def read_history(spark: SparkSession, table_path: str) -> DataFrame:
    return _read_or_empty(spark, history_path(table_path), schemas.HISTORY)


def visible(silver: DataFrame, invalid: DataFrame) -> DataFrame:
    """Silver minus given rows (anti join on row identity)."""
    return silver.join(invalid.select(*schemas.ROW_IDENTITY), schemas.ROW_IDENTITY, "left_anti")


def visible_rows(spark: SparkSession, silver: DataFrame, table_path: str, more: DataFrame | None = None) -> DataFrame:
    """What readers of the table at ``table_path`` see: ``silver`` (its stream sink) and ``more`` (its
    backfills) without the rows that runs have hidden."""
    run = newest_run(spark, table_path)
    if run is None:
        return silver if more is None else silver.unionByName(more)
    kept = spark.read.schema(schemas.KEPT).parquet(run.path + "/kept").drop("_copies")
    rows = silver.where(after(run.cutoff))
    if run.cutoff is not None:
        covered = silver.where(F.col("ingested_at") <= F.timestamp_micros(F.lit(run.cutoff)))
        stays = F.col("_from_cutoff").isNull() | (F.unix_micros("ingested_at") > F.col("_from_cutoff"))
        rows = rows.unionByName(covered.join(kept, "surrogate_key").where(stays).select(*silver.columns))
    if more is not None:
        seen = backfill_arrivals(spark, run)
        covered = more.join(seen, "ingested_at").join(kept, "surrogate_key").where(F.col("_first_version") >= F.col("_from_version"))
        rows = rows.unionByName(more.join(seen, "ingested_at", "left_anti")).unionByName(covered.select(*more.columns))
    return rows


def superseded(silver_visible: DataFrame, key: str = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Visible rows whose surrogate key is no winner key (what a run invalidates)."""
    return silver_visible.join(winners(silver_visible, key, order), "surrogate_key", "left_anti")


def retained(silver_visible: DataFrame, key: str = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Visible rows a run keeps (winner keys, their redelivered copies, tombstones)."""
    return silver_visible.join(winners(silver_visible, key, order), "surrogate_key", "left_semi")


def next_version(spark: SparkSession, table_path: str) -> int:
    """One past the highest version seen in the runs' log or the history log, and past every run that
    has begun to write (or failed while writing), so that two runs at once do not share a version."""
    run, logged = newest_run(spark, table_path), read_history(spark, table_path).agg(F.max("version").alias("v")).first()["v"]
    version = max(-1 if run is None else run.version, -1 if logged is None else logged) + 1
    while path_exists(spark, _version_path(table_path, version)):
        version += 1
    return version


def compact(
    spark: SparkSession,
    silver: DataFrame,
    table_path: str,
    key: str = KEY,
    order: tuple[str, ...] = ORDER,
    more: DataFrame | None = None,
) -> dict:
    """Hide every superseded visible row; log one history entry.

    ``silver`` must be the whole table at ``table_path`` and ``more`` all its backfills. Re-runnable:
    a second run over unchanged data hides nothing. Gold over the visible rows is unchanged
    by construction (winners are never hidden).

    Only rows that arrived since the newest run are read. Their narrow projection is used several
    times, so it is written once with a reliable checkpoint.
    """
    run, version = newest_run(spark, table_path), next_version(spark, table_path)
    path = _version_path(table_path, version)
    cols = list(dict.fromkeys(["surrogate_key", key, *order]))
    arrived = silver.where(after(run.cutoff if run else None)).select(*cols, "ingested_at", F.lit(True).alias("_stream"))
    if more is not None:
        fresh = more.join(backfill_arrivals(spark, run), "ingested_at", "left_anti")
        arrived = arrived.unionByName(fresh.select(*cols, "ingested_at", F.lit(False).alias("_stream")))
    shared_dir(spark)
    arrived = arrived.checkpoint(eager=True)
    seen = arrived.agg(
        F.count("ingested_at").alias("stamped"), F.count_if(F.col("ingested_at").isNull()).alias("unstamped"),
        F.unix_micros(F.max(F.when(F.col("_stream"), F.col("ingested_at")))).alias("at")).first()
    cutoff = seen["at"] if seen["at"] is not None else run.cutoff if run else None

    # mode("error"): a run that took the same version at the same moment fails
    ranked = arrived.select(*cols)
    if run is not None:
        ranked = ranked.unionByName(spark.read.schema(ranked.schema).parquet(run.path + "/winners"))
    latest_changes(ranked, key, order).write.mode("error").parquet(path + "/winners")

    earlier = read_kept(spark, table_path)
    kept = spark.read.parquet(path + "/winners").select("surrogate_key").distinct()
    # only copies of winners are counted: most arrived rows end at the semi join
    copies = arrived.where(F.col("ingested_at").isNotNull()).join(kept, "surrogate_key", "left_semi").groupBy("surrogate_key").agg(
        F.count(F.lit(1)).alias("_new"))
    written = Observation(f"kept-{version}")  # summed inside the write job
    kept.join(copies, "surrogate_key", "left").join(earlier, "surrogate_key", "left").select(
        "surrogate_key",
        (F.coalesce("_copies", F.lit(0)) + F.coalesce("_new", F.lit(0))).cast("long").alias("_copies"),
        F.coalesce("_from_version", F.lit(version)).cast("long").alias("_from_version"),
        F.when(F.col("_from_version").isNotNull(), F.col("_from_cutoff")).otherwise(
            F.lit(run.cutoff if run else None)).cast("long").alias("_from_cutoff"),
    ).observe(written, F.sum("_copies").alias("copies")).write.mode("error").parquet(path + "/kept")

    stamps = arrived.where(~F.col("_stream") & F.col("ingested_at").isNotNull()).select("ingested_at").distinct()
    stamps.withColumn("_first_version", F.lit(version).cast("long")).unionByName(backfill_arrivals(spark, run)).write.mode("error").parquet(
        path + "/arrivals")

    copies_before = 0 if run is None else earlier.agg(F.sum("_copies")).first()[0] or 0
    before = int(copies_before) + seen["unstamped"] + seen["stamped"]
    after_run = int(written.get.get("copies") or 0) + seen["unstamped"]
    entry = spark.createDataFrame([(version, cutoff)], schemas.SNAPSHOT_LOG)
    entry.coalesce(1).write.mode("error").parquet(f"{sidecar_path(table_path)}/log/entry={version}")
    metrics = {
        "numRowsBefore": str(before),
        "numDeletedRows": str(before - after_run),
        "numRowsAfter": str(after_run),
        "numRewrittenFiles": "0",
    }
    log = spark.createDataFrame(
        [(version, _dt.datetime.now(_dt.timezone.utc), "SOFT DELETE", metrics)], schemas.HISTORY
    )
    log.coalesce(1).write.mode("append").parquet(history_path(table_path))
    if version >= KEEP_VERSIONS:
        remove_path(spark, _version_path(table_path, version - KEEP_VERSIONS))
    return {"version": version, "before": before, "invalidated": before - after_run, "after": after_run}


def compaction_counts(silver_visible: DataFrame, key: str = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Counts before / after a run, as a one-row DataFrame (no write)."""
    tagged = silver_visible.select(F.lit(0).alias("gone")).unionByName(
        superseded(silver_visible, key, order).select(F.lit(1).alias("gone"))
    )
    before = F.count_if(F.col("gone") == 0)
    gone = F.count_if(F.col("gone") == 1)
    return tagged.agg(
        before.alias("rows_before"),
        gone.alias("rows_invalidated"),
        (before - gone).alias("rows_after"),
    )


def recent_history(spark: SparkSession, table_path: str, n: int = 5) -> DataFrame:
    """Last ``n`` maintenance runs, newest first."""
    return read_history(spark, table_path).orderBy(F.col("version").desc()).limit(n)
