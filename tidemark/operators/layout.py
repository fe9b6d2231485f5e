"""Visible silver in buckets, so that raw reads join with the kept keys without moving rows.

``maintenance.visible_rows`` joins every covered row with the kept keys, which shuffles silver on each
raw read. This layout stores the rows that runs have covered *and kept* bucketed by ``surrogate_key``,
and the kept keys of the newest run bucketed alike: both scans deliver the partitioning that the join
needs, so none of them is exchanged. Silver itself is not touched; hidden rows are not copied.

Each :func:`arrange` appends what arrived between the run before and the newest one (a folder a run,
all folders are one bucketed table) and writes the kept keys anew. Rows hidden by later runs stay in
their buckets and go by the join, under the same rule as in ``visible_rows``. Between two runs, readers
add the rows after the newest cut-off from silver; if a run has no layout yet, the rows
between the two cut-offs too, and only the kept keys move.

Hot keys: a bucket is one task. A surrogate key with more visible copies than a bucket's fair share goes
to a part of its own, without buckets, whose kept keys are at most one per bucket and run (Spark
broadcasts them by their measured size, or splits the hot key at runtime).

Bucketed scans need a table: readers register the folders as external tables of the session's
catalog, under a name made of the path. One writer at a time.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import path_exists, remove_path
from .maintenance import KEEP_VERSIONS, Run, backfill_arrivals, newest_run

LAYOUT_DIR = "_layout"
KEY = "surrogate_key"

#: Columns of a stored row beside silver's: the run that stored it, and of a backfilled row the run that covered it first.
_RUN, _ARRIVED = "_run", "_arrived_version"

#: The kept keys as the layout stores them: bucketed all of them, and beside the buckets those that were ever hot.
_KEPT = schemas.pick(schemas.KEPT, [KEY, "_from_version", "_from_cutoff"])


class Layout(NamedTuple):
    """The newest finished layout: the run it follows, its cut-off (microseconds) and number of buckets."""

    version: int
    cutoff: int | None
    buckets: int


def layout_path(table_path: str) -> str:
    return table_path.rstrip("/") + LAYOUT_DIR


def newest_layout(spark: SparkSession, table_path: str) -> Layout | None:
    log = layout_path(table_path) + "/log"
    if not path_exists(spark, log):
        return None
    found = spark.read.schema(schemas.LAYOUT_LOG).parquet(log).agg(
        F.max_by(F.struct("version", "cutoff", "buckets"), "version").alias("m")).first()["m"]
    return Layout(found["version"], found["cutoff"], found["buckets"])


def _table_name(path: str) -> str:
    return "tidemark_" + hashlib.md5(path.encode()).hexdigest()


def _write_buckets(df: DataFrame, path: str, buckets: int) -> None:
    """One sorted file for each bucket."""
    spark, name = df.sparkSession, _table_name(path) + "_new"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay


def _read_buckets(spark: SparkSession, path: str, schema, buckets: int) -> DataFrame:
    name = _table_name(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema.fields)}) USING parquet "
        f"OPTIONS (recursiveFileLookup 'true') CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _covered(spark: SparkSession, silver: DataFrame, more: DataFrame | None, run: Run, layout: Layout | None) -> DataFrame | None:
    """Rows that ``run`` covers and ``layout`` does not hold, or None if there can't be any."""
    parts = []
    if run.cutoff is not None and (layout is None or layout.cutoff != run.cutoff):
        rows = silver.where(F.col("ingested_at") <= F.timestamp_micros(F.lit(run.cutoff)))
        if layout is not None and layout.cutoff is not None:
            rows = rows.where(F.col("ingested_at") > F.timestamp_micros(F.lit(layout.cutoff)))
        parts.append(rows.withColumn(_ARRIVED, F.lit(None).cast("long")))
    if more is not None and (layout is None or layout.version != run.version):
        seen = backfill_arrivals(spark, run).withColumnRenamed("_first_version", _ARRIVED)
        if layout is not None:
            seen = seen.where(F.col(_ARRIVED) > layout.version)
        parts.append(more.join(seen, "ingested_at").select(*silver.columns, _ARRIVED))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _stay(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose surrogate key is kept since before they came."""
    streamed = F.col("_from_cutoff").isNull() | (F.unix_micros("ingested_at") > F.col("_from_cutoff"))
    stays = F.when(F.col(_ARRIVED).isNull(), streamed).otherwise(F.col(_ARRIVED) >= F.col("_from_version"))
    return rows.join(kept, KEY).where(stays).select(*rows.columns)


def arrange(spark: SparkSession, silver: DataFrame, table_path: str, buckets: int | None = None, more: DataFrame | None = None) -> dict:
    """Bring the layout up to the newest run: store the rows it covered and kept, and its kept keys.

    ``silver`` is the whole table at ``table_path`` and ``more`` all its backfills, as for ``compact``.
    ``buckets`` counts for the first call only (default: the session's shuffle partitions). Only rows that
    arrived since the layout before are read. Calling it twice after one run stores nothing twice.
    """
    run, layout = newest_run(spark, table_path), newest_layout(spark, table_path)
    if run is None:
        raise ValueError("nothing to arrange: compact the table first")
    if layout is not None and layout.version == run.version:
        return {"version": run.version, "buckets": layout.buckets, "stored": 0}
    n = layout.buckets if layout is not None else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = layout_path(table_path)
    rows_path, hot_path, kept_path = (f"{root}/{part}/run={run.version}" for part in ("rows", "hot", "kept"))
    for left_over in (rows_path, hot_path, kept_path, f"{root}/hot_kept/run={run.version}"):
        remove_path(spark, left_over)  # of a call that failed

    kept = spark.read.schema(schemas.KEPT).parquet(run.path + "/kept")
    total = kept.agg(F.sum("_copies")).first()[0] or 0
    hot = kept.where(F.col("_copies") > max(1, total // n)).select(KEY)  # at most n keys
    covered = _covered(spark, silver, more, run, layout)
    stored = 0
    if covered is not None:
        staying = _stay(covered, kept).withColumn(_RUN, F.lit(run.version).cast("long"))
        # mode("error"): two writers at once do not mix
        _write_buckets(staying.join(hot, KEY, "left_anti"), rows_path, n)
        staying.join(hot, KEY, "left_semi").write.mode("error").parquet(hot_path)
        stored = sum(spark.read.schema(staying.schema).parquet(p).count() for p in (rows_path, hot_path))
    _write_buckets(kept.drop("_copies"), kept_path, n)
    ever_hot = hot
    if layout is not None:
        ever_hot = hot.unionByName(spark.read.schema(_KEPT).parquet(f"{root}/hot_kept/run={layout.version}").select(KEY)).distinct()
    # a key once hot has rows there even when it is not kept any more
    ever_hot.join(kept.drop("_copies"), KEY, "left").write.mode("error").parquet(f"{root}/hot_kept/run={run.version}")

    entry = spark.createDataFrame([(run.version, run.cutoff, n)], schemas.LAYOUT_LOG)
    entry.coalesce(1).write.mode("error").parquet(f"{root}/log/entry={run.version}")
    for part in ("kept", "hot_kept"):
        remove_path(spark, f"{root}/{part}/run={run.version - KEEP_VERSIONS}")
    return {"version": run.version, "buckets": n, "stored": stored}


def visible_rows(spark: SparkSession, silver: DataFrame, table_path: str, more: DataFrame | None = None) -> DataFrame:
    """The rows of ``maintenance.visible_rows``, from the layout as far as it reaches."""
    from .maintenance import visible_rows as unarranged
    from .snapshot import after

    run, layout = newest_run(spark, table_path), newest_layout(spark, table_path)
    if layout is None:
        return unarranged(spark, silver, table_path, more)
    root, columns = layout_path(table_path), silver.columns
    stored = schemas.extend(silver.schema, {_ARRIVED: "long", _RUN: "long"})
    own = layout.version == run.version
    kept = (_read_buckets(spark, f"{root}/kept/run={run.version}", _KEPT, layout.buckets) if own
            else spark.read.schema(schemas.KEPT).parquet(run.path + "/kept").drop("_copies"))
    parts = [silver.where(after(run.cutoff))]
    if path_exists(spark, f"{root}/rows"):
        rows = _read_buckets(spark, f"{root}/rows", stored, layout.buckets).where(F.col(_RUN) <= layout.version)
        parts.append(_stay(rows, kept))
        hot = spark.read.schema(stored).option("recursiveFileLookup", "true").parquet(f"{root}/hot").where(F.col(_RUN) <= layout.version)
        hot_kept = spark.read.schema(_KEPT).parquet(f"{root}/hot_kept/run={layout.version}")
        parts.append(_stay(hot, hot_kept.where(F.col("_from_version").isNotNull()) if own else kept.join(hot_kept, KEY, "left_semi")))
    late = _covered(spark, silver, more, run, layout)
    if late is not None:
        parts.append(_stay(late, kept))
    if more is not None:
        parts.append(more.join(backfill_arrivals(spark, run), "ingested_at", "left_anti"))
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out
