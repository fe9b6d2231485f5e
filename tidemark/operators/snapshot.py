"""Incremental read of current state: a periodic per-key snapshot plus later arrivals.

The newest change per key is associative: the newest row over (the newest rows of
an earlier part of the table) ∪ (the rows added since) is the newest row over the
whole table. So a snapshot job writes ``latest_changes`` (tombstones included) of
the silver table together with one instant, the cut-off: the largest ``ingested_at``
among the rows it read. A gold read then ranks the snapshot and the rows past the
cut-off instead of the whole history; the predicate is pushed to the scan, where
row groups of earlier arrivals are skipped by their statistics. The result is
identical (tested against the full read). No file list and no rows pass through
the driver.

Why no row is missed: every micro-batch of a stream stamps its rows with the instant
it started, and one starts only after the one before has committed, so rows that a
snapshot did not see have a later stamp than all rows it saw. This holds as long as
the clock of the stream's driver does not run backwards. Backfills may overlap each
other, so they have no cut-off: they are ranked in full (``more``).

Snapshots are themselves incremental: version N+1 is built from version N plus the
later arrivals. The last few versions are kept for readers that still use them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import path_exists, remove_path
from ..sources.tables import read_silver
from .state import KEY, ORDER, current_state, latest_changes

SNAPSHOT_DIR = "_state"
KEEP_VERSIONS = 3


def snapshot_columns(schema) -> list[str]:
    """Columns a snapshot keeps: gold's columns plus the ordering columns."""
    skip = set(schemas.DELIVERY_COLUMNS) | set(schemas.INGEST_COLUMNS)
    gold = ["surrogate_key", *[f.name for f in schema.fields if f.name not in skip | {"surrogate_key"}]]
    return list(dict.fromkeys(gold + list(ORDER)))


def snapshot_path(table_path: str) -> str:
    return table_path.rstrip("/") + SNAPSHOT_DIR


def _newest(spark: SparkSession, table_path: str):
    """(version, cut-off) of the newest snapshot, or None."""
    log = snapshot_path(table_path) + "/log"
    if not path_exists(spark, log):
        return None
    found = spark.read.schema(schemas.SNAPSHOT_LOG).parquet(log)
    return found.agg(F.max(F.struct("version", "cutoff")).alias("m")).first()["m"]


def latest_version(spark: SparkSession, table_path: str) -> int | None:
    newest = _newest(spark, table_path)
    return None if newest is None else newest["version"]


def after(cutoff: int | None) -> Column:
    """Rows that arrived after the cut-off, in microseconds (all rows, without one); rows without a
    stamp always count."""
    if cutoff is None:
        return F.lit(True)
    return (F.col("ingested_at") > F.timestamp_micros(F.lit(cutoff))) | F.col("ingested_at").isNull()


def _state_inputs(spark: SparkSession, table_path: str, schema):
    """(rows to rank, the part of them that is new, base version, its cut-off)."""
    cols = snapshot_columns(schema)
    newest = _newest(spark, table_path)
    cutoff = newest["cutoff"] if newest is not None else None
    arrived = read_silver(spark, table_path, schema).where(after(cutoff))
    if newest is None:
        return arrived.select(*cols), arrived, None, None
    rows = spark.read.parquet(f"{snapshot_path(table_path)}/rows/version={newest['version']}")
    return rows.select(*cols).unionByName(arrived.select(*cols)), arrived, newest["version"], cutoff


def write_snapshot(spark: SparkSession, table_path: str, schema=schemas.SILVER, key: str = KEY) -> dict:
    """Write the next state snapshot (newest change per key, tombstones kept).

    Snapshots of a table are written one at a time; a second writer of the same version fails.
    """
    rows, arrived, base, cutoff = _state_inputs(spark, table_path, schema)
    version = 0 if base is None else base + 1
    # both read the files that were listed when ``arrived`` was made
    latest_changes(rows, key).write.mode("overwrite").parquet(f"{snapshot_path(table_path)}/rows/version={version}")
    seen = arrived.agg(F.count(F.lit(1)).alias("n"), F.unix_micros(F.max("ingested_at")).alias("at")).first()
    # The log entry is written after the rows: a reader only trusts a version that has
    # one, so a failed run leaves no half-visible snapshot.
    entry = spark.createDataFrame([(version, cutoff if seen["at"] is None else seen["at"])], schemas.SNAPSHOT_LOG)
    entry.coalesce(1).write.mode("error").parquet(f"{snapshot_path(table_path)}/log/entry={version}")
    if version >= KEEP_VERSIONS:
        remove_path(spark, f"{snapshot_path(table_path)}/rows/version={version - KEEP_VERSIONS}")
    return {"version": version, "arrived": seen["n"]}


def current_state_incremental(
    spark: SparkSession, table_path: str, schema=schemas.SILVER, key: str = KEY, more: DataFrame | None = None
) -> DataFrame:
    """Gold from the newest snapshot, the rows that arrived after it, and all rows of ``more`` (backfills)."""
    rows = _state_inputs(spark, table_path, schema)[0]
    if more is not None:
        rows = rows.unionByName(more.select(*snapshot_columns(schema)))
    return current_state(rows, key)
