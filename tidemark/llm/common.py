"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_work_path

#: A word is a run of anything but ASCII white space (fixed by the operators' contracts).
WORD_SEPARATORS = r"[\x20\x09-\x0D]+"

#: Sides up to this many bytes may be broadcast, once they are written and measured.
BROADCAST_BYTES = 32 << 20

#: Bounds of one Arrow batch: rows and bytes. Python workers hold a few batches at a time.
BATCH_ROWS = 96
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session's Python functions, so that very long texts fit."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Later steps start from these files: they survive lost executors, and every reader sees the
    same rows.
    """
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def measured(df: DataFrame, name: str, row_bytes: Column) -> DataFrame:
    """``df`` written once; marked for broadcast only if it measures under BROADCAST_BYTES.

    Beyond that the join stays a shuffled one, whose skewed keys the adaptive planner splits.
    """
    df = cut(df, name)
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def words_of(text: Column) -> Column:
    """Array of the text's words; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SEPARATORS), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words (long); 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def named_ids(df: DataFrame, id_col: str, text_col: str, more: Sequence[str] = ()) -> DataFrame:
    """Only the columns an operator works on, under names of its own.

    Whatever other columns the input has, however they are called, can't clash with the operator's.
    """
    return df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_{c}") for c in more])


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
