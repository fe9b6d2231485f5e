"""Audit, monitoring and reconciliation queries over silver and gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .. import schemas
from ..session import shared_dir
from ..sources.tables import read_silver, silver_exists
from . import keyed_scan
from .state import KEY, current_state


def counts_row(**frames: DataFrame) -> DataFrame:
    """One row with ``count(*)`` of each named frame, computed in a single job.

    Each frame is reduced to a tag column and the union is aggregated once: one scan per
    frame and no join.
    """
    tagged = None
    for i, df in enumerate(frames.values()):
        part = df.select(F.lit(i).alias("_tag"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.agg(
        *[F.count_if(F.col("_tag") == i).alias(name) for i, name in enumerate(frames)]
    )


def silver_total(silver: DataFrame) -> DataFrame:
    """Total raw events (A1)."""
    return silver.agg(F.count(F.lit(1)).alias("total_events"))


def event_mix(silver: DataFrame, key: str = KEY) -> DataFrame:
    """Events per key and operation type (A2); partial aggregation before the shuffle."""
    return (
        silver.groupBy(key, "operation_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(key, "operation_type")
    )


def newest(silver: DataFrame, n: int = 100, columns: list[str] | None = None) -> DataFrame:
    """Newest ``n`` silver rows by ingest time (T2), ties broken by feed position.

    ``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: each task keeps a
    top-n heap, only n rows per task reach the final merge.
    """
    cols = [c for c in (columns or schemas.PREVIEW_COLUMNS) if c in silver.columns]
    return (
        silver.orderBy(
            F.col("ingested_at").desc_nulls_last(),
            F.col("kafka_partition").desc_nulls_last(),
            F.col("kafka_event_offset").desc_nulls_last(),
        )
        .limit(n)
        .select(*cols)
    )


def preview(silver: DataFrame, n: int = 100, columns: list[str] | None = None) -> DataFrame:
    """The newest ``n`` rows and, beside each, how many rows there are in all (``total_events``)."""
    return newest(silver, n, columns).withColumn("total_events", silver_total(silver).scalar())


def duplicate_keys(silver: DataFrame, key: str = KEY) -> DataFrame:
    """Surrogate keys held by more than one silver row."""
    return (
        silver.groupBy("surrogate_key")
        .agg(
            F.min(key).alias(key),
            F.min("source_commit_lsn").alias("source_commit_lsn"),
            F.count(F.lit(1)).alias("copies"),
        )
        .where(F.col("copies") > 1)
    )


def key_stats(silver: DataFrame) -> DataFrame:
    """Rows, distinct surrogate keys and the number of duplicated keys."""
    per_key = silver.groupBy("surrogate_key").agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.sum("copies").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("copies") > 1).alias("duplicated_keys"),
        F.max("copies").alias("max_copies"),
    )


HEALTH_COUNTS = StructType(
    [
        StructField("silver_table_exists", BooleanType(), False),
        StructField("silver_count", LongType()),
        StructField("gold_count", LongType()),
    ]
)


def health_counts(silver: DataFrame | None, gold: DataFrame | None = None) -> DataFrame:
    """Health counts (H1): one row; counts are NULL when there is no table.

    ``gold`` defaults to the current state of ``silver``.
    """
    if silver is None:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([(False, None, None)], HEALTH_COUNTS)
    counts = counts_row(silver_count=silver, gold_count=current_state(silver) if gold is None else gold)
    return counts.select(F.lit(True).alias("silver_table_exists"), "silver_count", "gold_count")


def health_counts_at(spark: SparkSession, path: str, schema=schemas.SILVER) -> DataFrame:
    return health_counts(read_silver(spark, path, schema) if silver_exists(spark, path) else None)


def silver_vs_gold(silver: DataFrame, key: str = KEY) -> dict[str, DataFrame]:
    """Raw silver next to gold (D1): total, event mix, current rows ordered by key."""
    return {
        "total": silver_total(silver),
        "event_mix": event_mix(silver, key),
        "gold": current_state(silver, key).orderBy(key),
    }


def _overflows(column: str):
    """A balance that DECIMAL(14,2) can't hold; shown as NULL, it must not match a NULL."""
    c = F.col(column)
    return c.isNotNull() & c.try_cast(schemas.BALANCE_DECIMAL).isNull()


def _source_side(source: DataFrame, key: str) -> DataFrame:
    return source.select(
        F.col(key).alias("_k"),
        F.lit(True).alias("_in_source"),
        F.col("current_balance").try_cast(schemas.BALANCE_DECIMAL).alias("source_balance"),
        _overflows("current_balance").alias("_source_over"),
        F.col("currency").alias("source_currency"),
        F.col("transaction_timestamp").cast("timestamp").alias("source_ts"),
    )


def _gold_side(gold: DataFrame, key: str) -> DataFrame:
    return gold.select(
        F.col(key).alias("_kg"),
        F.lit(True).alias("_in_gold"),
        F.col("current_balance").try_cast(schemas.BALANCE_DECIMAL).alias("gold_balance"),
        _overflows("current_balance").alias("_gold_over"),
        F.col("currency").alias("gold_currency"),
        F.col("transaction_timestamp").try_cast("timestamp").alias("gold_ts"),
    )


def _compared(s: DataFrame, g: DataFrame, key: str) -> DataFrame:
    joined = s.join(g, s["_k"].eqNullSafe(g["_kg"]), "full_outer")
    same = (
        F.col("source_balance").eqNullSafe(F.col("gold_balance"))
        & F.col("source_currency").eqNullSafe(F.col("gold_currency"))
        & F.col("source_ts").eqNullSafe(F.col("gold_ts"))
        & ~F.col("_source_over")
        & ~F.col("_gold_over")
    )
    status = (
        F.when(F.col("_in_gold").isNull(), "source_only")
        .when(F.col("_in_source").isNull(), "gold_only")
        .when(same, "match")
        .otherwise("value_diff")
    )
    return joined.select(
        F.coalesce(F.col("_k"), F.col("_kg")).alias(key),
        status.alias("status"),
        "source_balance",
        "gold_balance",
        "source_currency",
        "gold_currency",
        "source_ts",
        "gold_ts",
    )


def reconcile(source: DataFrame, gold: DataFrame, key: str = KEY) -> DataFrame:
    """Per-key comparison of the source table with gold.

    ``status`` is match / value_diff / source_only / gold_only. Gold balances are
    compared as DECIMAL(14,2) and gold event times as timestamps, NULL-safely; a balance
    beyond that type is shown as NULL and counts as value_diff.
    Full outer join on the key (null-safe), one shuffle per side.
    """
    return _compared(_source_side(source, key), _gold_side(gold, key), key)


#: Ranges of key hashes that :func:`reconcile_by_digest` tells apart, as bits; and the bits a level descends.
DIGEST_BITS = 16
LEVEL_BITS = 4
MAX_DIGEST_BITS = 20


def _bucketed(side: DataFrame, key_col: str, bits: int) -> DataFrame:
    """``side`` with its key's range of hashes (``_bucket``)."""
    return side.withColumn("_bucket", F.shiftrightunsigned(F.xxhash64(F.lit("range"), F.col(key_col).isNull(), key_col), 64 - bits))


def _digests(side: DataFrame, prefix: str, key_col: str) -> DataFrame:
    """One row for each bucket: the number of its rows and two 64-bit combinations of their hashes."""
    over = F.when(F.col(f"_{prefix}_over"), F.lit(prefix))  # what can't be compared differs from the other side
    values = [F.col(c) for c in (key_col, f"{prefix}_balance", f"{prefix}_currency", f"{prefix}_ts")] + [over]
    marked = [x for v in values for x in (v.isNull(), v)]  # a hash skips nulls
    return side.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), *[
        F.bit_xor(F.xxhash64(F.lit(seed), *marked)).alias(f"d{seed}") for seed in (1, 2)])


def differing_buckets(a: DataFrame, b: DataFrame, bits: int = DIGEST_BITS) -> DataFrame:
    """Buckets whose digests differ, found from the top: a level's digests combine those below, and only
    the children of ranges that differ are compared."""
    digest = ["n", "d1", "d2"]
    wanted = None
    for level in [*range(LEVEL_BITS, bits, LEVEL_BITS), bits]:
        up = bits - level

        def rolled(x: DataFrame) -> DataFrame:
            rows = x.withColumn("range", F.shiftright("_bucket", up))
            if wanted is not None:
                rows = rows.withColumn("above", F.shiftright("range", level - wanted[1])).join(wanted[0], "above", "left_semi")
            return rows.groupBy("range").agg(F.sum("n").alias("n"), F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"))

        left, right = rolled(a), rolled(b).select(F.col("range").alias("other"), *[F.col(c).alias(f"other_{c}") for c in digest])
        same = F.lit(True)
        for c in digest:
            same = same & F.col(c).eqNullSafe(F.col(f"other_{c}"))
        found = left.join(right, F.col("range") == F.col("other"), "full_outer").where(~same).select(F.coalesce("range", "other").alias("above"))
        wanted = (found, level)
    return wanted[0].withColumnRenamed("above", "_bucket")


def reconcile_by_digest(source: DataFrame, gold: DataFrame, key: str = KEY, bits: int = DIGEST_BITS) -> DataFrame:
    """The rows of :func:`reconcile`, joining only ranges of keys in which the sides differ.

    Both sides are digested by 2^``bits`` ranges of key hashes (partial aggregates; the digests have a
    bounded size whatever the tables have, and are written once). Digests are compared from the top
    down; a range whose digests agree holds the same rows on both sides, so its rows are matches as they
    are and are never shuffled. What is joined grows with the number of differences.
    """
    from ..session import new_work_path

    if not 1 <= bits <= MAX_DIGEST_BITS:
        raise ValueError(f"bits must be 1 to {MAX_DIGEST_BITS}: the list of differing ranges is broadcast")
    spark = source.sparkSession
    sides = {"source": _bucketed(_source_side(source, key), "_k", bits), "gold": _bucketed(_gold_side(gold, key), "_kg", bits)}
    digests = {}
    for name, key_col in (("source", "_k"), ("gold", "_kg")):
        path = new_work_path(spark, f"digests-{name}")
        _digests(sides[name], name, key_col).write.parquet(path)
        digests[name] = spark.read.parquet(path)
    path = new_work_path(spark, "digests-differ")
    differing_buckets(digests["source"], digests["gold"], bits).write.parquet(path)
    differ = F.broadcast(spark.read.schema("_bucket long").parquet(path))  # 2^bits rows of 8 bytes at most
    joined = _compared(*(sides[name].join(differ, "_bucket", "left_semi").drop("_bucket") for name in ("source", "gold")), key)
    equal = sides["source"].join(differ, "_bucket", "left_anti").select(
        F.col("_k").alias(key), F.lit("match").alias("status"), "source_balance", F.col("source_balance").alias("gold_balance"),
        "source_currency", F.col("source_currency").alias("gold_currency"), "source_ts", F.col("source_ts").alias("gold_ts"))
    return joined.unionByName(equal)


def reconcile_summary(source: DataFrame, gold: DataFrame, key: str = KEY) -> DataFrame:
    return reconcile(source, gold, key).groupBy("status").agg(F.count(F.lit(1)).alias("accounts"))


def replay_invariance(silver: DataFrame, replay: DataFrame, key: str = KEY) -> DataFrame:
    """Gold over silver ∪ replay equals gold over silver, while silver grows (D3).

    One row: silver sizes before/after, gold size and the multiset difference of
    gold both ways (both 0 when replay is harmless).
    """
    grown = silver.unionByName(replay)
    # Each gold (one row per key) is used three times: materialise it once.
    shared_dir(silver.sparkSession)
    gold_before = current_state(silver, key).checkpoint(eager=True)
    gold_after = current_state(grown, key).checkpoint(eager=True)
    return counts_row(
        silver_rows_before=silver,
        silver_rows_after=grown,
        gold_rows=gold_before,
        gold_only_before=gold_before.exceptAll(gold_after),
        gold_only_after=gold_after.exceptAll(gold_before),
    )


def lost_offsets(rows: DataFrame, expected: DataFrame | None = None, partition: str = "kafka_partition", offset: str = "kafka_event_offset",
                 ranges: int | None = None) -> DataFrame:
    """Runs of feed positions that never arrived (S1): (partition, first_lost, last_lost, lost).

    The source tolerates data loss (records that the broker dropped before they were read), which
    leaves gaps between the offsets of a partition. Redelivered positions count once; rows without a
    position are left out. ``expected`` (partition, first, next) says where each partition should
    begin and which offset comes after its last, so that losses at the ends, and partitions of which
    nothing arrived, show as well.

    Gaps and islands, cut by ranges: positions are dealt out by ranges of (partition, offset), each
    compares neighbours, and one row per range and partition carries the last position on. So a
    partition is never one task. On a compacted topic gaps are normal.
    """
    at = rows.where(F.col(partition).isNotNull() & F.col(offset).isNotNull()).select(
        F.col(partition).cast("int").alias(partition), F.col(offset).cast("long").alias(offset))
    if expected is not None:
        ends = expected.select(F.col("partition").cast("int").alias(partition), F.explode(F.array((F.col("first") - 1).cast("long"), F.col("next").cast("long"))).alias(offset))
        at = at.unionByName(ends)
    scanned = keyed_scan.prefix_scan(at, partition, offset, max_before={"_previous": offset}, ranges=ranges)
    gap = F.col(offset) - F.col("_previous")
    # positions that repeat see the same gap
    return scanned.where(gap > 1).select(partition, (F.col("_previous") + 1).alias("first_lost"), (F.col(offset) - 1).alias("last_lost"),
                                         (gap - 1).alias("lost")).distinct()


def lateness(silver: DataFrame, key: str = KEY, lsn: str = "source_commit_lsn", offset: str = "kafka_event_offset", ranges: int | None = None) -> DataFrame:
    """Late changes per key (R3): (key, changes, late, largest_lag).

    A change is late if one with a greater ``lsn`` came before it, by offset; its lag is how far the
    greatest of those is ahead. Changes without lsn or offset count, but are never late. The prefix
    maximum has two levels (inside ranges of (key, offset), and over one row per range), so a key with
    most of the rows is cut like any other.
    """
    narrow = silver.select(key, lsn, offset)
    placed = narrow.where(F.col(lsn).isNotNull() & F.col(offset).isNotNull())
    scanned = keyed_scan.prefix_scan(placed, key, offset, max_before={"_ahead": lsn}, ranges=ranges)
    lag = F.when(F.col("_ahead") > F.col(lsn), F.col("_ahead") - F.col(lsn))
    other = narrow.where(F.col(lsn).isNull() | F.col(offset).isNull()).select(key, F.lit(None).cast("long").alias("lag"))
    return scanned.select(key, lag.alias("lag")).unionByName(other).groupBy(key).agg(
        F.count(F.lit(1)).alias("changes"), F.count("lag").alias("late"), F.coalesce(F.max("lag"), F.lit(0)).alias("largest_lag"))


def delivery(feed: DataFrame, silver: DataFrame) -> DataFrame:
    """How the records of a feed landed, per feed partition: (kafka_partition, fed, landed, lost, repeated).

    ``lost`` counts records of a position short of those fed, ``repeated`` rows beyond them. Both sides
    are counted by position first (map-side), then joined by it.
    """
    position = ["kafka_partition", "kafka_event_offset"]
    fed = feed.groupBy(F.col("partition").alias(position[0]), F.col("offset").alias(position[1])).agg(F.count(F.lit(1)).alias("fed"))
    landed = silver.groupBy(*position).agg(F.count(F.lit(1)).alias("landed"))
    both = fed.join(landed, position, "full_outer").select(
        position[0], F.coalesce("fed", F.lit(0)).alias("fed"), F.coalesce("landed", F.lit(0)).alias("landed"))
    short = F.col("fed") - F.col("landed")
    return both.groupBy(position[0]).agg(F.sum("fed").alias("fed"), F.sum("landed").alias("landed"), F.sum(F.greatest(short, F.lit(0))).alias("lost"),
                                         F.sum(F.greatest(-short, F.lit(0))).alias("repeated"))
