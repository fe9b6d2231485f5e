"""Table registration and batch reads of silver and the source table."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import path_exists


def empty(spark: SparkSession, schema) -> DataFrame:
    """An empty frame the optimizer *knows* is empty (``limit(0)`` folds into an empty
    relation), so joins against it are pruned instead of shuffling the other side."""
    return spark.createDataFrame([], schema).limit(0)


def read_silver(spark: SparkSession, path: str, schema=schemas.SILVER) -> DataFrame:
    """Batch scan of a silver directory with the fixed schema.

    A streaming sink directory is read through its metadata log, so only committed
    micro-batches are seen; a table of the sized sink through its own log. A missing path
    reads as empty (same schema); any other read error is raised.
    """
    from ..streaming import sized

    if not path_exists(spark, path):
        return empty(spark, schema)
    if sized.is_sized(spark, path):
        return sized.read_parts(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def silver_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def register_silver(spark: SparkSession, path: str, view: str = schemas.SILVER_VIEW) -> DataFrame:
    """Register silver as a view over its path (sees new micro-batches at once,
    unlike a catalog table whose file listing can go stale)."""
    df = read_silver(spark, path)
    df.createOrReplaceTempView(view)
    return df


# The five seed accounts of the source table.
SEED_ACCOUNTS = [
    (1001, "500.00"),
    (1002, "1250.75"),
    (1003, "0.00"),
    (1004, "9999.99"),
    (1005, "42.10"),
]
SEED_CURRENCY = "USD"


def seed_source(spark: SparkSession, at: _dt.datetime | None = None) -> DataFrame:
    """The seed rows of the source table (all USD, stamped ``at``)."""
    at = at or _dt.datetime(2024, 1, 1, tzinfo=_dt.timezone.utc)
    rows = [(k, Decimal(b), SEED_CURRENCY, at, at) for k, b in SEED_ACCOUNTS]
    return spark.createDataFrame(rows, schemas.SOURCE)


def snapshot_changes(source: DataFrame, lsn: int = 0, offset_base: int = -1) -> DataFrame:
    """Source rows -> snapshot-read changes (op ``r``) in the relational change form
    used by :func:`tidemark.sources.feed.envelope_records`."""
    return source.select(
        F.col("account_id").cast("long").alias("account_id"),
        F.lit(lsn).cast("long").alias("lsn"),
        F.lit("r").alias("op"),
        F.col("transaction_timestamp").cast("timestamp").alias("ts"),
        F.col("current_balance").cast("double").alias("value"),
        (F.lit(offset_base) - F.col("account_id")).cast("long").alias("off"),
        F.lit(False).alias("junk"),
    )


def source_from_changes(changes: DataFrame) -> DataFrame:
    """The source table as it stands after applying relational changes in commit order.

    This is the reference state a reconciliation compares gold against: newest change
    per account by LSN, deletes removed, exact balances. One shuffle by account with
    a partial top-1 before it.
    """
    valid = changes.where(~F.col("junk") & F.col("account_id").isNotNull())
    w = Window.partitionBy("account_id").orderBy(F.col("lsn").desc_nulls_last(), F.col("off").desc_nulls_last())
    latest = valid.withColumn("rn", F.row_number().over(w)).where("rn = 1").where(F.col("op") != "d")
    ts = F.col("ts").cast("timestamp")
    currency = F.col("currency") if "currency" in changes.columns else F.lit(SEED_CURRENCY)
    return latest.select(
        "account_id",
        F.col("value").try_cast(schemas.BALANCE_DECIMAL).alias("current_balance"),
        currency.alias("currency"),
        ts.alias("transaction_timestamp"),
        ts.alias("updated_at"),
    )


def source_snapshot(source: DataFrame) -> DataFrame:
    """The source table's five columns, ordered by key."""
    return source.select(*[f.name for f in schemas.SOURCE.fields]).orderBy("account_id")
