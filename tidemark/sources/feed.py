"""Change-feed sources: the broker source, a file-backed feed, and the test feed.

The broker source needs the Kafka connector on the classpath; where it is absent,
the same record schema is read from Parquet files (batch or ``readStream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.envelope import envelope_timestamp

# Broker source options of the reference deployment.
KAFKA_TOPIC = "cdc.public.accounting"
KAFKA_OPTIONS = {
    "subscribe": KAFKA_TOPIC,
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
}


def kafka_options(
    bootstrap: str,
    topic: str = KAFKA_TOPIC,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``: one topic, from earliest, tolerate retention gaps.

    For large backlogs: ``max_offsets_per_trigger`` bounds every micro-batch (an
    ``availableNow`` drain then runs as many bounded batches), and ``min_partitions``
    splits busy broker partitions over more Spark tasks than there are partitions.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, **KAFKA_OPTIONS, "subscribe": topic}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra)
    return opts


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str = KAFKA_TOPIC, **options) -> DataFrame:
    """Streaming DataFrame over the broker topic (requires the Kafka connector jar)."""
    try:
        return spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, **options)).load()
    except Exception as exc:  # the provider is resolved at load(); say what to do
        text = str(exc).lower()
        if "kafka" in text and ("find data source" in text or "not found" in text or "data_source_not_found" in text):
            raise RuntimeError(
                "the Kafka source is not on the classpath: start Spark with the "
                "spark-sql-kafka connector, or read feed records from files with file_stream()"
            ) from exc
        raise


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over Parquet files holding feed records (same columns as the broker)."""
    reader = spark.readStream.schema(schemas.FEED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def file_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FEED).parquet(path)


#: Records of a feed file, about 10 MB: a micro-batch of more is several files, parsed by as many tasks.
FILE_RECORDS = 100_000


def files_each(records: DataFrame, batches: int) -> int:
    """How many files each of ``batches`` micro-batches over ``records`` has."""
    return max(1, -(-records.count() // (batches * FILE_RECORDS)))


def write_files(records: DataFrame, path: str, batches: int, each: int, mode: str = "error") -> None:
    """Write ``records`` as the feed files of ``batches`` micro-batches, ``each`` files for one (``file_stream``'s
    ``max_files_per_trigger``); rows are dealt out evenly."""
    records.repartition(batches * each).write.mode(mode).parquet(path)


def _row_image(account_id, balance, currency, ts_text):
    return F.struct(
        account_id.cast("long").alias("account_id"),
        balance.alias("current_balance"),
        currency.alias("currency"),
        ts_text.alias("transaction_timestamp"),
        ts_text.alias("updated_at"),
    )


def envelope_records(changes: DataFrame, currency: str = "USD") -> DataFrame:
    """Relational changes -> feed records with JSON envelopes.

    ``changes`` columns: account_id, lsn, op, ts (timestamp), value (balance),
    off (record offset), junk (bool: emit a malformed payload instead), and
    optionally currency (else ``currency`` for every row).
    A ``d`` puts the row image in ``before``; every other op puts it in ``after``.
    """
    ts = F.col("ts").cast("timestamp")
    ts_text = envelope_timestamp(ts)
    cur = F.col("currency") if "currency" in changes.columns else F.lit(currency)
    image = _row_image(F.col("account_id"), F.col("value"), cur, ts_text)
    is_delete = F.col("op") == "d"
    ts_ms = F.unix_millis(ts)
    env = F.struct(
        F.when(is_delete, image).alias("before"),
        F.when(~is_delete, image).alias("after"),
        F.struct(F.col("lsn").cast("long").alias("lsn"), ts_ms.alias("ts_ms")).alias("source"),
        F.col("op").alias("op"),
        ts_ms.alias("ts_ms"),
    )
    return changes.select(
        F.when(F.col("junk"), F.lit("{bad")).otherwise(F.to_json(env)).alias("value"),
        F.col("off").cast("long").alias("offset"),
        F.coalesce(F.col("account_id") % 3, F.lit(0)).cast("int").alias("partition"),
        ts.alias("timestamp"),
    )


# Fixed values of the test feed (see FIXTURES.md section 3).
LATE_EVERY = 7  # every 7th change arrives late: offset order differs from lsn order
LATE_SHIFT = 10**15  # shifts lie so far apart that offsets never meet for lsn under 10**15
REDELIVER_EVERY = 10  # every 10th change is delivered twice
REDELIVER_SHIFT = 2 * 10**15
JUNK_EVERY = 997  # every 997th change also yields a malformed record
JUNK_SHIFT = 4 * 10**15
SNAPSHOT_TS = "2023-12-31 00:00:00"


def fixture_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relational test feed derived from ``events`` and ``customer``.

    Grows linearly with both tables; all work is narrow except the final union.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    ev = events.select(
        (F.col("event_id") + 1).alias("lsn"),
        F.col("user_id").alias("account_id"),
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
        .alias("op"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value"),
    )
    lsn = F.col("lsn")
    main = ev.select(
        "account_id", "lsn", "op", "ts", "value",
        F.when(lsn % LATE_EVERY == 0, lsn + LATE_SHIFT).otherwise(lsn).alias("off"),
        F.lit(False).alias("junk"),
    )
    dup = ev.where(lsn % REDELIVER_EVERY == 0).select(
        "account_id", "lsn", "op", "ts", "value",
        (lsn + REDELIVER_SHIFT).alias("off"),
        F.lit(False).alias("junk"),
    )
    snap = customer.select(
        F.col("c_custkey").alias("account_id"),
        F.lit(0).cast("long").alias("lsn"),
        F.lit("r").alias("op"),
        F.lit(SNAPSHOT_TS).cast("timestamp").alias("ts"),
        F.col("c_acctbal").alias("value"),
        (F.lit(-1) - F.col("c_custkey")).alias("off"),
        F.lit(False).alias("junk"),
    )
    junk = lsn % JUNK_EVERY == 0
    # The junk flag is computed from the data (not a literal) so that the
    # optimizer cannot constant-fold the malformed branch into literals.
    bad = ev.where(junk).select(
        F.lit(None).cast("long").alias("account_id"),
        F.lit(None).cast("long").alias("lsn"),
        F.lit(None).cast("string").alias("op"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.lit(None).cast("double").alias("value"),
        (lsn + JUNK_SHIFT).alias("off"),
        junk.alias("junk"),
    )
    return main.unionByName(dup).unionByName(snap).unionByName(bad)


def fixture_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed records (value, offset, partition, timestamp) of the test feed."""
    return envelope_records(fixture_changes(spark, sf_dir))
