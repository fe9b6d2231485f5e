"""Hard negatives against a brute-force version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives


def by_brute_force(rows, anchor, positives=5, negatives=5, least=80, scale=256):
    known = []
    for key, label, vector in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            known.append((key, label, [math.floor(scale * x) for x in vector]))
    id_order = lambda key: (key is None, key or 0)
    out = []
    for at, (key, label, v) in enumerate(known):
        if not anchor(key):
            continue
        scored = sorted(((sum(a * b for a, b in zip(v, w)), id_order(k), i, k, other) for i, (k, other, w) in enumerate(known) if i != at),
                        key=lambda s: (-s[0], s[1], s[2]))
        for score, _, _, k, _ in [s for s in scored if s[4] == label][:positives]:
            hard = [s for s in scored if s[4] != label and least * score <= 100 * s[0] <= 100 * score][:negatives]
            out += [(key, k, i + 1, s[3], score, s[0]) for i, s in enumerate(hard)]
    return sorted(out, key=str)


def mined(spark, rows, schema="vec_id long, label int, embedding array<float>", **options):
    frame = spark.createDataFrame(rows, schema)
    return sorted(map(tuple, hard_negatives.mine(frame, F.col("vec_id") % 10 == 0, **options).collect()), key=str)


def anchored(key):
    return key is not None and key % 10 == 0


def single(x):
    return [float(np.float32(v)) for v in x]


@pytest.mark.parametrize("dims,spread", [(3, 0.05), (16, 0.3), (2, 2.0)])
def test_matches_brute_force(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(hard_negatives, "PASS_VALUES", 64)  # several passes
    rng = random.Random(dims)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(i, rng.randint(0, 2), single(rng.choice((0.1, 1, 5)) * (c + rng.gauss(0, spread)) for c in rng.choice(centres))) for i in range(300)]
    rows += [(1000 + i, 1, rows[20][2]) for i in range(60)]  # copies of an anchor's vector
    assert mined(spark, rows) == by_brute_force(rows, anchored)


def test_small_buckets_are_pruned_and_exact(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, i % 2, single(rng.gauss(0, 1) for _ in range(4))) for i in range(200)]
    bucket = hard_negatives.Bucket(next(iter(packs(rows))))
    vector = np.array([256, 0, 0, 0])
    exact = bucket.matrix @ vector
    for least in (1, 20_000, 60_000, 120_000):
        found = bucket.candidates(vector / 256, 256.0, least)
        assert set(np.flatnonzero(exact >= least)) <= set(found)
    assert len(bucket.candidates(vector / 256, 256.0, 60_000)) < 100


def packs(rows):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]),
         pa.array([[math.floor(256 * x) for x in r[2]] for r in rows], pa.list_(pa.int64()))], ["row", "id", "label", "v"])
    for b in hard_negatives._packed(iter([batch])):
        yield from b.to_pylist()


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.0]), (3, 2, [1.0, 0.0]), (None, 2, [0.9, 0.0]), (None, 1, [0.5]),
            (4, None, [1.0, 0.0]), (5, 2, None), (6, 2, [nan, 1.0]), (7, 2, [inf, 1.0]), (8, 2, [None, 1.0]), (9, 2, []), (10, 3, [0.0, 0.0]),
            (11, 3, [0.0, -1.0]), (12, 3, [0.0, 1.0]), (20, 4, [-1.0, 0.0]), (21, 4, [1.0, 0.0])]
    assert mined(spark, rows) == by_brute_force(rows, anchored)
    assert mined(spark, rows, positives=1, negatives=2, least_percent=50) == by_brute_force(rows, anchored, 1, 2, 50)
    clashing = spark.createDataFrame([r + (1, 2.0) for r in rows], "vec_id long, label int, embedding array<double>, row int, score double")
    assert sorted(map(tuple, hard_negatives.mine(clashing, F.col("vec_id") % 10 == 0).collect()), key=str) == by_brute_force(rows, anchored)
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == []  # no anchor


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, i % 2, [float(rng.randint(-10**6, 10**6) * 1000 + rng.randint(0, 5)) for _ in range(3)]) for i in range(60)]
    schema = "vec_id long, label int, embedding array<double>"
    assert mined(spark, rows, schema, scale=1) == by_brute_force(rows, anchored, scale=1)
