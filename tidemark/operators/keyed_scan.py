"""Exact per-key prefix scans that never put a whole key into one task.

A sequential rule per key ("is the account there before this request?", "what is
the balance after it?") is a prefix scan over the key's rows in ``seq`` order. A
plain ``Window.partitionBy(key)`` would send every row of a hot key to one task.

:func:`place` deals the rows out by *ranges* of (key, seq), so the cuts follow the
number of rows, whatever gaps ``seq`` has, and writes them once with the number of
their range, so that every later use sees the same cuts. A scan then has two levels:

1. inside each (key, range) group, an ordinary running window;
2. one partial state per (key, range), combined over a key's earlier ranges into
   what the group starts from (the carry), and joined back.

There is one plan for all keys, hot or not. As ranges are contiguous in (key, seq),
a range starts inside at most one key: the carry has fewer rows than there are
ranges, and the window over a key's partial states at most one row per range.
``seq`` must be unique within a key.

Shuffles: one by range (written to the shared folder ``spark.checkpoint.dir``), one
by (key, range) for the windows, which later scans over the same frame reuse, and
small ones of partial states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

_KN, _KK, _RANGE = "_scan_key_null", "_scan_key", "_scan_range"
PARTITION_COLS = [_KN, _KK, _RANGE]


def place(df: DataFrame, key: str, seq: str, ranges: int | None = None) -> DataFrame:
    """Rows with the grouping columns of the scans, written once.

    A NULL key is a group of its own (as in SQL ``PARTITION BY``); the flag column
    keeps it apart from the filler value, so joins stay plain equi-joins. ``ranges``
    is the number of ranges (default: the session's shuffle partitions, small ones
    merged at runtime).
    """
    if _RANGE in df.columns:
        return df
    filler = F.lit(0).cast(df.schema[key].dataType)
    keyed = df.select("*", F.col(key).isNull().alias(_KN), F.coalesce(F.col(key), filler).alias(_KK))
    order = [_KN, _KK, seq]
    dealt = keyed.repartitionByRange(ranges, *order) if ranges else keyed.repartitionByRange(*order)
    shared_dir(df.sparkSession)  # checkpoint target must be the shared folder
    return dealt.withColumn(_RANGE, F.spark_partition_id()).checkpoint(eager=True)


def drop_scan_partitioning(df: DataFrame) -> DataFrame:
    return df.drop(*PARTITION_COLS)


def _in_group(seq: str):
    return Window.partitionBy(*PARTITION_COLS).orderBy(F.col(seq))


def _upto(seq: str):
    return _in_group(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier():
    return Window.partitionBy(_KN, _KK).orderBy(_RANGE)


def _with_carry(rows: DataFrame, states: DataFrame, columns: dict) -> DataFrame:
    """``rows`` with what each group starts from: ``columns`` over the states of a key's earlier ranges.

    Groups that start their key have none, so the joined side stays under one row per range.
    """
    carry = states.select(
        *PARTITION_COLS, *[c.alias(name) for name, c in columns.items()], F.row_number().over(_earlier()).alias("_scan_nth")
    ).where("_scan_nth > 1").drop("_scan_nth")
    return rows.join(carry, PARTITION_COLS, "left")


def prefix_scan(
    df: DataFrame,
    key: str,
    seq: str,
    last_before: dict[str, str] | None = None,
    last_upto: dict[str, str] | None = None,
    running_sum: dict[str, str] | None = None,
    ranges: int | None = None,
    max_before: dict[str, str] | None = None,
) -> DataFrame:
    """Add per-key prefix columns in ``seq`` order.

    * ``last_before[out] = src``: last non-NULL ``src`` among earlier rows of the key;
    * ``last_upto[out] = src``: same, the current row included;
    * ``running_sum[out] = src``: sum of ``src`` up to and including the row
      (NULL-valued rows add nothing; 0 when nothing was added);
    * ``max_before[out] = src``: largest non-NULL ``src`` among earlier rows of the key. Rows of equal
      ``seq`` are not before each other, so here ``seq`` may repeat (it must be a whole number).

    The grouping columns are kept so a following scan places nothing again; drop
    them with :func:`drop_scan_partitioning`.
    """
    last_before, last_upto, running_sum, max_before = last_before or {}, last_upto or {}, running_sum or {}, max_before or {}
    d = place(df, key, seq, ranges)
    before = _in_group(seq).rowsBetween(Window.unboundedPreceding, -1)
    past = _earlier().rowsBetween(Window.unboundedPreceding, -1)

    lasts = sorted({*last_before.values(), *last_upto.values()})
    sums = sorted(set(running_sum.values()))
    tops = sorted(set(max_before.values()))
    lower = _in_group(seq).rangeBetween(Window.unboundedPreceding, -1)
    local = d.select(
        "*",
        *[F.last(F.col(s), ignorenulls=True).over(before).alias(f"_scan_lb_{s}") for s in sorted(set(last_before.values()))],
        *[F.last(F.col(s), ignorenulls=True).over(_upto(seq)).alias(f"_scan_lu_{s}") for s in sorted(set(last_upto.values()))],
        *[F.sum(F.col(s)).over(_upto(seq)).alias(f"_scan_rs_{s}") for s in sums],
        *[F.max(F.col(s)).over(lower).alias(f"_scan_mb_{s}") for s in tops],
    )
    # the partial states need no window: newest non-NULL value and sum, combined on the map side
    states = d.groupBy(*PARTITION_COLS).agg(
        F.count(F.lit(1)).alias("_scan_n"),
        *[F.max_by(F.col(s), F.when(F.col(s).isNotNull(), F.col(seq))).alias(f"_scan_l_{s}") for s in lasts],
        *[F.sum(F.col(s)).alias(f"_scan_s_{s}") for s in sums],
        *[F.max(F.col(s)).alias(f"_scan_m_{s}") for s in tops],
    )
    joined = _with_carry(local, states, {
        **{f"_scan_cl_{s}": F.last(F.col(f"_scan_l_{s}"), ignorenulls=True).over(past) for s in lasts},
        **{f"_scan_cs_{s}": F.sum(F.col(f"_scan_s_{s}")).over(past) for s in sums},
        **{f"_scan_cm_{s}": F.max(F.col(f"_scan_m_{s}")).over(past) for s in tops},
    })
    out = []
    for name, s in last_before.items():
        out.append(F.coalesce(F.col(f"_scan_lb_{s}"), F.col(f"_scan_cl_{s}")).alias(name))
    for name, s in last_upto.items():
        out.append(F.coalesce(F.col(f"_scan_lu_{s}"), F.col(f"_scan_cl_{s}")).alias(name))
    for name, s in running_sum.items():
        zero = F.lit(0).cast(df.schema[s].dataType)
        out.append((F.coalesce(F.col(f"_scan_rs_{s}"), zero) + F.coalesce(F.col(f"_scan_cs_{s}"), zero)).alias(name))
    for name, s in max_before.items():
        out.append(F.greatest(F.col(f"_scan_mb_{s}"), F.col(f"_scan_cm_{s}")).alias(name))
    made = {*last_before, *last_upto, *running_sum, *max_before}
    return joined.select(*[c for c in d.columns if c not in made], *out)


def set_or_add(placed: DataFrame, seq: str, set_col: str, add_col: str, out: str) -> DataFrame:
    """Add ``out``: a key's value after each row, where a row sets it (``set_col`` not NULL), adds to
    it (``add_col`` not NULL) or leaves it; NULL until it is first set.

    With P the running sum of what is added, the value is the newest ``set - P`` plus P. Both sums
    start anew in each range, and one carry holds what a key's earlier ranges leave. ``placed`` has
    the columns of :func:`place`.
    """
    zero = F.lit(0).cast(placed.schema[add_col].dataType)
    past = _earlier().rowsBetween(Window.unboundedPreceding, -1)
    added = F.coalesce(F.col(add_col), zero)
    local = placed.withColumn("_scan_p", F.sum(added).over(_upto(seq))).withColumn(
        "_scan_anchor", F.col(set_col) - F.col("_scan_p")
    ).withColumn("_scan_base", F.last("_scan_anchor", ignorenulls=True).over(_upto(seq)))
    states = local.groupBy(*PARTITION_COLS).agg(
        F.sum(added).alias("_scan_total"),
        F.max_by("_scan_anchor", F.when(F.col("_scan_anchor").isNotNull(), F.col(seq))).alias("_scan_a"),
    ).withColumn("_scan_before", F.coalesce(F.sum("_scan_total").over(past), zero))
    joined = _with_carry(local, states, {
        "_scan_cp": F.col("_scan_before"),
        "_scan_cb": F.last(F.col("_scan_a") - F.col("_scan_before"), ignorenulls=True).over(past),
    })
    value = F.coalesce(F.col("_scan_base"), F.col("_scan_cb") + F.col("_scan_cp")) + F.col("_scan_p")
    return joined.select(*placed.columns, value.alias(out))
