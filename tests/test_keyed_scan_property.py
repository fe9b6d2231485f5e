"""Property: the two-level scan equals a straight per-key scan for any number of ranges
(hot and ordinary keys, NULL keys, gaps in seq); a sparse seq cuts a hot key by rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.keyed_scan import PARTITION_COLS, drop_scan_partitioning, place, prefix_scan

rows_strategy = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 4)),  # key (NULL is a group)
        st.one_of(st.none(), st.integers(-50, 50)),  # value
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, ranges=st.integers(1, 12), gap=st.sampled_from([1, 3, 10_000_000]))
def test_scan_over_ranges_equals_straight_scan(spark, rows, ranges, gap):
    data = [(k, i * gap, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, s long, v long")
    out = drop_scan_partitioning(
        prefix_scan(
            df, "k", "s",
            last_before={"lb": "v"}, last_upto={"lu": "v"}, running_sum={"rs": "v"},
            ranges=ranges,
        )
    ).collect()
    assert len(out) == len(data)
    for r in out:
        same = [(s, v) for k, s, v in data if k == r["k"]]
        before = [v for s, v in same if s < r["s"] and v is not None]
        upto = [v for s, v in same if s <= r["s"] and v is not None]
        assert r["lb"] == (before[-1] if before else None)
        assert r["lu"] == (upto[-1] if upto else None)
        assert r["rs"] == sum(upto)


def test_sparse_seq_is_cut_by_rows(spark):
    """One key, positions ten million apart: as many groups as ranges, of like size."""
    df = spark.range(20_000).selectExpr("7L AS k", "id * 10000000 AS s", "id AS v")
    sizes = [r["count"] for r in place(df, "k", "s", ranges=16).groupBy(*PARTITION_COLS).count().collect()]
    assert len(sizes) <= 16 and sum(sizes) == 20_000 and max(sizes) < 20_000 / 4
