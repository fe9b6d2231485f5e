"""Append sink with control over file sizes: balanced micro-batches, and bins of small files.

The plain file sink writes a file for each task and month of every micro-batch. Here a micro-batch goes
through ``foreachBatch``: its rows are rebalanced by month (Spark merges small shuffle partitions and
splits large ones at runtime, so a month with most of the rows is not one task) and written as one
*part* of the table. :func:`pack` merges parts: their small files are dealt into bins of about the
target size, month by month, and each bin is rewritten as one file.

Layout: ``parts/<name>`` folders with month partitions, and a log of one-row entries (first and last
micro-batch, folder). A part that a wider one covers is no longer read. The log entry is written after
the rows, so a reader never sees half a part, and a micro-batch that comes again after a crash
finds its entry and does nothing: each record lands exactly once.

Packing is tiered: it takes the newest parts, from the oldest one on that is no larger than
``TIER`` times all that are newer. So a row is rewritten a number of times that grows with the logarithm
of the table, and there are as few parts. What a pack replaced stays until the next one, for
readers that still use it. One stream and one packer at a time write a table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import schemas
from ..operators.ingest import to_silver
from ..session import path_exists, remove_path
from ..sources.tables import empty

TARGET_BYTES = 128 << 20
#: A file under this share of the target is small.
SMALL = 0.5
TIER = 4

_LOG = StructType([StructField("first", LongType()), StructField("last", LongType()), StructField("part", StringType())])
_BIN = "_bin"


class Part(NamedTuple):
    """A folder of rows: the micro-batches that it holds, and its name."""

    first: int
    last: int
    name: str


def log_path(table_path: str) -> str:
    return table_path.rstrip("/") + "/_log"


def _part_root(table_path: str) -> str:
    return table_path.rstrip("/") + "/parts"


def _part_path(table_path: str, name: str) -> str:
    return f"{_part_root(table_path)}/part={name}"


def is_sized(spark: SparkSession, table_path: str) -> bool:
    return path_exists(spark, log_path(table_path))


def _logged(spark: SparkSession, table_path: str) -> list[Part]:
    # one row for each micro-batch since the last two packs, and each tier
    log = spark.read.schema(_LOG).parquet(log_path(table_path))
    return [Part(*r) for r in log.select("first", "last", "part").collect()]


def live_parts(spark: SparkSession, table_path: str) -> list[Part]:
    """The parts that readers use, oldest first: a chain of the widest ones."""
    if not is_sized(spark, table_path):
        return []
    found = sorted(_logged(spark, table_path), key=lambda p: (p.first, -p.last))
    chain: list[Part] = []
    for part in found:
        if not chain or part.first > chain[-1].last:
            chain.append(part)
    return chain


def _read(spark: SparkSession, table_path: str, parts: list[Part], schema) -> DataFrame:
    rows = spark.read.schema(schema).option("basePath", _part_root(table_path)).parquet(*[_part_path(table_path, p.name) for p in parts])
    return rows.select(*[f.name for f in schema.fields], "_metadata")


def read_parts(spark: SparkSession, table_path: str, schema=schemas.SILVER) -> DataFrame:
    """All committed rows; a table without any reads as empty."""
    parts = live_parts(spark, table_path)
    if not parts:
        return empty(spark, schema)
    return _read(spark, table_path, parts, schema).drop("_metadata")


def _commit(spark: SparkSession, table_path: str, part: Part) -> None:
    entry = spark.createDataFrame([tuple(part)], _LOG)
    entry.coalesce(1).write.mode("error").parquet(f"{log_path(table_path)}/entry={part.name}")


def write_batch(rows: DataFrame, batch_id: int, table_path: str, target_bytes: int = TARGET_BYTES) -> bool:
    """Append one micro-batch's silver rows as a part; False if it has been committed before."""
    spark, name = rows.sparkSession, f"batch-{batch_id}"
    if path_exists(spark, f"{log_path(table_path)}/entry={name}") or any(p.first <= batch_id <= p.last for p in live_parts(spark, table_path)):
        return False
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))  # of the micro-batch's own session
    # overwrite: what a failed attempt at this batch left
    rows.hint("rebalance", "event_month").write.mode("overwrite").partitionBy("event_month").parquet(_part_path(table_path, name))
    _commit(spark, table_path, Part(batch_id, batch_id, name))
    return True


def start_sized_ingest(source: DataFrame, table_path: str, mode: str = "once", checkpoint: str | None = None, interval: str | None = None,
                       target_bytes: int = TARGET_BYTES, exact_decimal: bool = False, spec=None) -> StreamingQuery:
    """Start the feed -> silver query into a sized table; returns the running query.

    Modes and checkpoint as in ``ingest.start_ingest``. A new checkpoint over a table with rows is
    refused: its batch numbers would start anew and count as committed.
    """
    from .ingest import DEFAULT_INTERVAL, checkpoint_path

    if not source.isStreaming:
        raise ValueError("start_sized_ingest needs a streaming source (readStream)")
    if mode not in ("once", "stream"):
        raise ValueError(f"unknown mode {mode!r}: use 'once' or 'stream'")
    spark = source.sparkSession
    checkpoint = checkpoint or checkpoint_path(table_path)
    if is_sized(spark, table_path) and not path_exists(spark, checkpoint):
        raise ValueError(f"{table_path} already holds parts but checkpoint {checkpoint} is new; reset both together")

    def append(batch: DataFrame, batch_id: int) -> None:
        write_batch(to_silver(batch, exact_decimal=exact_decimal, spec=spec), batch_id, table_path, target_bytes)

    writer = source.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if mode == "once" else writer.trigger(processingTime=interval or DEFAULT_INTERVAL)
    return writer.start()


def file_sizes(spark: SparkSession, table_path: str, parts: list[Part] | None = None) -> DataFrame:
    """(part, event_month, file, bytes) of the parts' files (default: those that readers use); from the
    listing, no content is read."""
    parts = live_parts(spark, table_path) if parts is None else parts
    if not parts:
        return empty(spark, "part string, event_month string, file string, bytes long")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(
        [_part_path(table_path, p.name) for p in parts])
    path = F.col("path")
    return listed.select(F.regexp_extract(path, "/part=([^/]+)/", 1).alias("part"), F.regexp_extract(path, "event_month=([^/]+)/", 1).alias("event_month"),
                         F.regexp_extract(path, "([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"))


def bins(files: DataFrame, target_bytes: int) -> DataFrame:
    """``files`` with ``_bin``, numbered from 0: neighbours of a month go together until they reach the target size.

    A bin takes the small files that begin within its stretch of the month's bytes, so it holds between
    1 - SMALL and 1 + SMALL times the target; only a month's last bin may hold less. A file that is not
    small is a bin of its own.
    """
    month, order = Window.partitionBy("event_month"), Window.partitionBy("event_month").orderBy("part", "file")
    small = F.col("bytes") < target_bytes * SMALL
    filled = F.coalesce(F.sum(F.when(small, F.col("bytes"))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # small files are under the target, so no number is left out
    in_month = files.withColumn("_small", F.when(small, F.floor(filled / target_bytes))).withColumn(
        "_nth", F.coalesce("_small", F.coalesce(F.max("_small").over(month) + 1, F.lit(0)) + F.sum((~small).cast("long")).over(order) - 1))
    # a row for each month
    starts = in_month.groupBy("event_month").agg((F.max("_nth") + 1).alias("_bins")).select(
        "event_month", F.coalesce(F.sum("_bins").over(Window.orderBy("event_month").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return in_month.join(starts, "event_month").select(*files.columns, (F.col("_start") + F.col("_nth")).cast("int").alias(_BIN))


def pack(spark: SparkSession, table_path: str, target_bytes: int = TARGET_BYTES, schema=schemas.SILVER) -> dict:
    """Merge the newest parts into one of well-sized files; returns what was done.

    Rows stay as they are, in number and content. Nothing happens if fewer than two parts would merge.
    """
    parts = live_parts(spark, table_path)
    # one number for each part
    size = {r["part"]: r["bytes"] for r in file_sizes(spark, table_path, parts).groupBy("part").agg(F.sum("bytes").alias("bytes")).collect()}
    n_taken, newer = 0, 0
    for n, part in enumerate(reversed(parts), 1):
        if size.get(part.name, 0) <= TIER * max(newer, target_bytes):
            n_taken = n
        newer += size.get(part.name, 0)
    taken = parts[len(parts) - n_taken:]
    if len(taken) < 2:
        return {"merged": 0, "parts": len(parts)}
    first, last = taken[0].first, taken[-1].last
    merged = Part(first, last, f"pack-{first}-{last}")
    binned = bins(file_sizes(spark, table_path, taken), target_bytes).select("event_month", "file", _BIN)
    columns = [f.name for f in schema.fields]
    rows = _read(spark, table_path, taken, schema)
    # a file's name has its write job's id; one task's files in different months have the same
    # a row for each file, as in Spark's own listing: the rows of the parts are shuffled by bin only
    dealt = rows.select(*columns, F.col("_metadata.file_name").alias("file")).join(F.broadcast(binned), ["event_month", "file"]).drop("file")
    n = (binned.agg(F.max(_BIN)).first()[0] or 0) + 1
    # a bin a task, which writes one file
    dealt.repartitionById(n, _BIN).drop(_BIN).write.mode("overwrite").partitionBy("event_month").parquet(_part_path(table_path, merged.name))
    gone = _covered_before(spark, table_path, parts)
    _commit(spark, table_path, merged)
    for part in gone:  # replaced by an earlier pack
        remove_path(spark, f"{log_path(table_path)}/entry={part.name}")
        remove_path(spark, _part_path(table_path, part.name))
    return {"merged": len(taken), "parts": len(parts) - len(taken) + 1}


def _covered_before(spark: SparkSession, table_path: str, live: list[Part]) -> list[Part]:
    """Parts of the log that are not read any more."""
    return [p for p in _logged(spark, table_path) if p not in live]
