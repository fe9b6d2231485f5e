"""Read-time resolution of current state from the append-only event table.

The newest change per key wins, ordered by commit position (``source_commit_lsn``),
then by feed position (``kafka_event_offset``), then ``kafka_partition`` as a
deterministic tie-break. NULLs sort last under DESC, so a change without a
commit position never beats one that has it.

Plan shape: ``row_number() ... = 1`` lets Catalyst insert a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most one row
per key; a key holding a third of the table costs one row per map partition,
not a third of the table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.envelope import DELETE_OP

KEY = "account_id"
ORDER = ("source_commit_lsn", "kafka_event_offset", "kafka_partition")


def latest_order(order: tuple[str, ...] = ORDER) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def rank_latest(silver: DataFrame, key: str = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Silver with ``rn`` = 1 for the newest change of each key."""
    w = Window.partitionBy(key).orderBy(*latest_order(order))
    return silver.withColumn("rn", F.row_number().over(w))


def latest_changes(silver: DataFrame, key: str = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """The newest change per key, deletes included (tombstones)."""
    return rank_latest(silver, key, order).where(F.col("rn") == 1).drop("rn")


def latest_by_aggregate(rows: DataFrame, key: str = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """The rows of :func:`latest_changes` as an aggregate: the row of greatest position, ``max_by`` over structs.

    The aggregate is mergeable: it combines on the map side (one row per key and task crosses the
    network), and applied to results over parts of a table it gives the result over the whole. A struct
    compares field by field with NULL lowest, which is the window's order, and the winning row is taken as
    it is, its NULLs included. There is no window; Spark plans a sort aggregate (structs can't be
    updated in place), which sorts by the key alone.
    """
    row = F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order))
    latest = rows.groupBy(key).agg(row.alias("_row"))
    return latest.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in rows.columns])


def current_state_by_aggregate(silver: DataFrame, key: str = KEY, order: tuple[str, ...] = ORDER, columns: list[str] | None = None) -> DataFrame:
    """Gold through :func:`latest_by_aggregate`: the rows of :func:`current_state`."""
    cols = columns or gold_columns_of(silver)
    needed = list(dict.fromkeys([key, *cols, *order, "operation_type"]))
    return latest_by_aggregate(silver.select(*needed), key, order).where(F.col("operation_type") != DELETE_OP).select(*cols)


def winners(silver: DataFrame, key: str = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Surrogate keys of the newest change per key (deletes are NOT filtered)."""
    return latest_changes(silver.select("surrogate_key", key, *order), key, order).select("surrogate_key")


def gold_columns_of(silver: DataFrame) -> list[str]:
    """Gold's columns for any silver: surrogate key, then the captured row's columns,
    commit position and operation (delivery and ingest columns dropped)."""
    skip = set(schemas.DELIVERY_COLUMNS) | set(schemas.INGEST_COLUMNS) | {"surrogate_key"}
    return ["surrogate_key", *[c for c in silver.columns if c not in skip]]


def current_state(
    silver: DataFrame,
    key: str = KEY,
    order: tuple[str, ...] = ORDER,
    columns: list[str] | None = None,
) -> DataFrame:
    """Gold: newest change per key, deletes hidden *after* ranking.

    Filtering deletes before the window would resurrect an older row of a
    deleted key, so the predicate must stay above the window (it does).
    Unknown ops pass the filter.

    Pass the whole table: a key's changes span months, so filtering ``event_month``
    *before* this call would rank per-month winners. Key predicates are safe either
    way (they are pushed through the window to the scan).
    """
    cols = columns or gold_columns_of(silver)
    latest = latest_changes(silver, key, order)
    return latest.where(F.col("operation_type") != DELETE_OP).select(*cols)


def lookup(gold: DataFrame, key_value, key: str = KEY) -> DataFrame:
    """Point lookup; the key predicate is pushed through the window to the scan.

    ``None`` finds the NULL-key group (junk records), as ``IS NULL``.
    """
    if key_value is None:
        return gold.where(F.col(key).isNull())
    return gold.where(F.col(key) == F.lit(key_value))


def register_views(
    spark: SparkSession,
    silver: DataFrame,
    silver_view: str = schemas.SILVER_VIEW,
    gold_view: str = schemas.GOLD_VIEW,
    key: str = KEY,
) -> None:
    """Register silver and the gold view (nothing is materialised)."""
    silver.createOrReplaceTempView(silver_view)
    current_state(silver, key).createOrReplaceTempView(gold_view)
