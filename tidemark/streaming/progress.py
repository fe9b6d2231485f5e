"""What a stream did, micro-batch by micro-batch: its own reports, and the sink's commit log.

:class:`BatchReports` listens to the session's streams and keeps, for each micro-batch, the number of
records read and what the ingest observed of the rows it wrote (their number, first and last
ingest stamp). :func:`sink_log` reads which files the plain file sink committed in which
micro-batch. Together they show that a stopped and restarted stream landed every record once, and
that all rows of a micro-batch carry one stamp, later than the stamp of the one before.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

#: Name of the ingest's observed metrics in a progress report.
OBSERVED = "tidemark_ingest"

REPORTS = StructType([
    StructField("run_id", StringType()),
    StructField("batch_id", LongType()),
    StructField("records_read", LongType()),
    StructField("rows", LongType()),
    StructField("first_stamp", TimestampType()),
    StructField("last_stamp", TimestampType()),
])


def observed(silver: DataFrame) -> DataFrame:
    """``silver`` with the metrics that a report shows of each micro-batch (no further pass over it)."""
    return silver.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), F.min("ingested_at").alias("first_stamp"), F.max("ingested_at").alias("last_stamp"))


class BatchReports(StreamingQueryListener):
    """Reports of micro-batches with data, newest ``keep`` of them; use as a context manager.

    Reports come a moment after their micro-batch: :meth:`wait_for` waits until a query's are there.
    """

    def __init__(self, spark: SparkSession, keep: int = 10_000):
        self._spark, self._keep, self._lock = spark, keep, threading.Lock()
        self._found: list[tuple] = []
        self._ended: set[str] = set()

    def __enter__(self) -> BatchReports:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(OBSERVED)
        if p.numInputRows or (seen is not None and seen["rows"]):
            row = (str(p.runId), p.batchId, p.numInputRows, *((seen["rows"], seen["first_stamp"], seen["last_stamp"]) if seen else (None,) * 3))
            with self._lock:
                self._found = [*self._found, row][-self._keep:]

    def count(self, query: StreamingQuery | None = None) -> int:
        with self._lock:
            return sum(query is None or r[0] == str(query.runId) for r in self._found)

    def wait_for(self, query: StreamingQuery, batches: int | None = None, seconds: float = 120.0) -> None:
        """Until ``query`` has reported so many micro-batches with data, or (None) has ended."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            with self._lock:
                if str(query.runId) in self._ended or (batches is not None and sum(r[0] == str(query.runId) for r in self._found) >= batches):
                    return
            if query.exception() is not None:
                raise query.exception()
            time.sleep(0.05)
        raise TimeoutError(f"no report of query {query.runId} within {seconds} s")

    def table(self) -> DataFrame:
        """One row for each reported micro-batch; a batch that a restart ran again, for each run that reported it."""
        with self._lock:
            return self._spark.createDataFrame(list(self._found), REPORTS)


def sink_log(spark: SparkSession, table_path: str) -> DataFrame:
    """(batch_id, path): the files that each micro-batch committed to a file sink.

    Entries that Spark has merged into a ``.compact`` file, and whose own file is gone, are not listed
    (it keeps them for some minutes, and merges every tenth).
    """
    # an RDD of its small files: the DataFrame readers skip folders whose name begins with an underscore
    files = spark.createDataFrame(spark.sparkContext.wholeTextFiles(table_path.rstrip("/") + "/_spark_metadata/[0-9]*"), "name string, content string")
    lines = files.select(F.regexp_extract("name", "([^/]+)$", 1).alias("entry"), F.explode(F.split("content", "\n")).alias("value"))
    entry = F.from_json("value", "path string, action string")
    return lines.where(F.col("entry").rlike("^[0-9]+$") & F.col("value").startswith("{")).select(
        F.col("entry").cast("long").alias("batch_id"), entry["path"].alias("path"), entry["action"].alias("action")).where(
        "action = 'add'").drop("action")


def stamps_by_batch(silver: DataFrame, log: DataFrame) -> DataFrame:
    """(batch_id, rows, first_stamp, last_stamp): the ingest stamps that each micro-batch's files hold.

    ``silver`` must be the scan of the sink's table itself. Rows are grouped by file before they meet the log.
    """
    by_file = silver.groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"),
                             F.col("_metadata.file_path").alias("at")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("ingested_at").alias("first"), F.max("ingested_at").alias("last"))
    # the month folder and the file's name: a task's files in different months have one name
    key = F.array_join(F.slice(F.split("at", "/"), -2, 2), "/")
    log_key = F.array_join(F.slice(F.split("path", "/"), -2, 2), "/")
    return by_file.select(key.alias("key"), "rows", "first", "last").join(log.select(log_key.alias("key"), "batch_id"), "key").groupBy("batch_id").agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first_stamp"), F.max("last").alias("last_stamp"))


def stamp_check(reports: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: micro-batches, rows, those with one stamp, those with a later one than the batch before,
    and those whose stored rows and stamps are what the stream observed."""
    before = F.lag("last_stamp").over(Window.orderBy("batch_id"))  # a row for each micro-batch
    seen = reports.select("batch_id", F.col("rows").alias("seen"), F.col("first_stamp").alias("seen_first"), F.col("last_stamp").alias("seen_last"))
    joined = stored.withColumn("before", before).join(seen, "batch_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"),
        F.count_if(F.col("first_stamp") == F.col("last_stamp")).alias("one_stamp"),
        F.count_if(F.col("before").isNull() | (F.col("first_stamp") > F.col("before"))).alias("later_stamp"),
        F.count_if((F.col("rows") == F.col("seen")) & (F.col("first_stamp") == F.col("seen_first")) & (F.col("last_stamp") == F.col("seen_last"))).alias("as_observed"))
