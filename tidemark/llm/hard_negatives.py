"""Hard negatives by coordinate pruning over length buckets.

Rows are sorted by the length of their vectors and cut into buckets; a bucket holds, for each coordinate,
its rows in the order of their unit vectors' values there. An anchor that looks for inner products of
at least a threshold turns it, with the bucket's greatest length, into a least cosine. A bucket whose
cosine would have to exceed 1 is skipped. In any other, each focus coordinate (the anchor's largest)
leaves a range of feasible values: with ``b`` the angle of the anchor's value and ``c`` that of the
cosine, cos(b + c) to cos(b - c). The rows that are in all these ranges are the candidates; their inner
products are then computed exactly, in integers. Thresholds rise as a task finds better rows.

Anchors are a stated query set. They travel in packs: each pass broadcasts packs up to a fixed size and
reads all buckets, so memory does not grow with the number of anchors, and no pair of rows is ever a
row of a join. A task hands on at most the wanted number of rows for each anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small_batches

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score is this share of the positive's at least (percent), and not above it.
LEAST_PERCENT = 80

#: Bounds of a bucket and of a pack of anchors: rows, and values.
BUCKET_ROWS = 2048
BUCKET_VALUES = 1 << 18
#: Values of the anchors that one pass broadcasts (8 bytes each).
PASS_VALUES = 1 << 21
FOCUS = 4

#: Stands for a null id, which comes after all others.
_NO_ID = (1 << 63) - 1
_SLACK = 1e-9


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    """(row, id, label, v, squared, anchor) of the rows that take part; ``row`` tells repeated rows apart."""
    x = F.col("vector")
    finite = F.forall(x, lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)))
    return rows.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor")).where(
        F.col("label").isNotNull() & x.isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), "id", "label", F.transform(x, lambda e: F.floor(e * scale)).alias("v"), "anchor"
    ).withColumn("squared", F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double")))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (row, id, label, v) rows as buckets, in the order in which they come."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]] = []

    def bucket() -> pa.RecordBatch:
        rows, ids, labels = (np.concatenate([p[i] for p in parts]) for i in range(3))
        vectors = [v for p in parts for v in p[3]]
        width = max(map(len, vectors))
        matrix = np.zeros((len(rows), width), np.int64)
        for at, v in enumerate(vectors):
            matrix[at, :len(v)] = v
        parts.clear()
        units, lengths = _units(matrix)
        order = np.argsort(units, axis=0, kind="stable").T.astype(np.uint16)
        small = next(t for t in (np.int16, np.int32, np.int64) if not matrix.size or np.abs(matrix).max() <= np.iinfo(t).max)
        return pa.RecordBatch.from_pylist([{
            "first": int(rows[0]), "n": len(rows), "width": width, "kind": np.dtype(small).str, "longest": float(lengths.max()),
            "rows": rows.tobytes(), "ids": ids.tobytes(), "labels": labels.tobytes(), "matrix": matrix.astype(small).tobytes(),
            "sorted": order.tobytes()}], schema=_BUCKET)

    held, widest = 0, 0
    for batch in batches:
        rows, ids, labels = (batch.column(i).to_numpy() for i in range(3))
        lists = batch.column(3)
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        for at in range(len(rows)):
            wide = max(widest, offsets[at + 1] - offsets[at])
            if held and (held >= BUCKET_ROWS or (held + 1) * wide > BUCKET_VALUES):
                yield bucket()
                held, wide = 0, offsets[at + 1] - offsets[at]
            held, widest = held + 1, wide
            parts.append((rows[at:at + 1], ids[at:at + 1], labels[at:at + 1], [values[offsets[at]:offsets[at + 1]]]))
    if held:
        yield bucket()


_BUCKET = pa.schema([("first", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("kind", pa.string()), ("longest", pa.float64()),
                     *[(name, pa.binary()) for name in ("rows", "ids", "labels", "matrix", "sorted")]])
_BUCKET_DDL = "first long, n int, width int, kind string, longest double, rows binary, ids binary, labels binary, matrix binary, sorted binary"


def _units(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero stays zero) and lengths."""
    real = matrix.astype(np.float64)
    lengths = np.sqrt((real * real).sum(axis=1))
    return real / np.where(lengths > 0, lengths, 1)[:, None], lengths


class Bucket:
    """Rows of about one length, with sorted coordinate lists."""

    def __init__(self, row: dict):
        self.rows, self.ids, self.labels = (np.frombuffer(row[k], np.int64) for k in ("rows", "ids", "labels"))
        self.matrix = np.frombuffer(row["matrix"], row["kind"]).reshape(row["n"], row["width"]).astype(np.int64)
        self.order = np.frombuffer(row["sorted"], np.uint16).reshape(row["width"], row["n"])
        self.units, self.lengths = _units(self.matrix)
        self.lists = np.take_along_axis(self.units, self.order.T.astype(np.int64), axis=0).T
        self.longest, self.largest = row["longest"], int(np.abs(self.matrix).max(initial=0))
        self.real = self.matrix.astype(np.float64)

    def candidates(self, unit: np.ndarray, length: float, least: float) -> np.ndarray:
        """Places of the rows that may reach an inner product of ``least`` with the anchor."""
        every = np.arange(len(self.rows))
        if least <= 0:
            return every  # as good as no threshold
        if length * self.longest <= 0 or (cosine := least / (length * self.longest) - _SLACK) > 1:
            return every[:0]
        width = min(len(unit), len(self.lists))
        focus = np.argsort(-np.abs(unit[:width]), kind="stable")[:FOCUS]
        if not len(focus):
            return every[:0]
        b, c = np.arccos(np.clip(unit[focus], -1, 1)), np.arccos(cosine)
        low, high = np.cos(np.minimum(np.pi, b + c)) - _SLACK, np.cos(np.maximum(0, b - c)) + _SLACK
        ranges = [(np.searchsorted(self.lists[f], lo), np.searchsorted(self.lists[f], hi, "right"), f, lo, hi) for f, lo, hi in zip(focus, low, high)]
        ranges.sort(key=lambda r: r[1] - r[0])
        start, end, f = ranges[0][:3]
        found = self.order[f][start:end].astype(np.int64)
        for start, end, f, lo, hi in ranges[1:]:
            if end - start < len(every):
                values = self.units[found, f]
                found = found[(values >= lo) & (values <= hi)]
        return found

    def scores(self, places: np.ndarray, vector: np.ndarray, real: np.ndarray, largest: int) -> np.ndarray:
        """Exact integer inner products; a shorter vector counts as filled up with zeros."""
        width = min(len(vector), self.matrix.shape[1])
        if largest * self.largest * max(width, 1) < 1 << 53:
            return (self.real[places, :width] @ real[:width]).astype(np.int64)
        return self.matrix[places, :width] @ vector[:width]


class Best:
    """The ``wanted`` best rows so far: by score, then id, then row."""

    def __init__(self, wanted: int):
        self.wanted = wanted
        self.score = self.id = self.row = np.empty(0, np.int64)

    def least(self) -> float:
        return self.score[-1] if len(self.score) == self.wanted else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        score, ids, rows = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.row, rows)))
        first = np.lexsort((rows, ids, -score))[:self.wanted]
        self.score, self.id, self.row = score[first], ids[first], rows[first]


class Anchors:
    """The anchors of one pass, as broadcast."""

    def __init__(self, packs: list):
        self.rows, self.ids, self.labels = (np.concatenate([np.frombuffer(p[k], np.int64) for p in packs]) for k in ("rows", "ids", "labels"))
        self.vectors = [v for p in packs for v in np.frombuffer(p["matrix"], p["kind"]).reshape(p["n"], p["width"]).astype(np.int64)]

    def each(self) -> Iterator[tuple]:
        for at, vector in enumerate(self.vectors):
            real = vector.astype(np.float64)
            length = float(np.sqrt(real @ real))
            yield at, vector, real, real / (length or 1), length, int(np.abs(vector).max(initial=0))


_FOUND_DDL = "anchor_row long, anchor_id long, bound long, score long, id long, row long"


def _search(shared, wanted: int, same_label: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best rows of a task's buckets for each anchor and each of its score bounds.

    ``shared`` has the Anchors, and by anchor its (least, most) bounds on the score.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, bounds = shared.value
        every = list(anchors.each())
        best = [[Best(wanted) for _ in b] for b in bounds]
        for batch in batches:
            for row in batch.to_pylist():
                bucket = Bucket(row)
                for at, vector, real, unit, length, largest in every:
                    if not bounds[at]:
                        continue
                    least = [max(low, b.least()) for (low, _), b in zip(bounds[at], best[at])]
                    places = bucket.candidates(unit, length, min(least))
                    if same_label:
                        places = places[(bucket.labels[places] == anchors.labels[at]) & (bucket.rows[places] != anchors.rows[at])]
                    else:
                        places = places[bucket.labels[places] != anchors.labels[at]]
                    if not len(places):
                        continue
                    scores = bucket.scores(places, vector, real, largest)
                    for (_, most), low, b in zip(bounds[at], least, best[at]):
                        good = (scores >= low) & (scores <= most)
                        if good.any():
                            b.add(scores[good], bucket.ids[places[good]], bucket.rows[places[good]])
        found = [(a, i, most, b) for a, i, bs, own in zip(anchors.rows, anchors.ids, bounds, best) for (_, most), b in zip(bs, own)]
        counts = [len(b.score) for *_, b in found]
        columns = [np.repeat(np.array([f[k] for f in found], np.int64), counts) for k in range(3)]
        columns += [np.concatenate([getattr(b, k) for *_, b in found] or [np.empty(0, np.int64)]) for k in ("score", "id", "row")]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         ["anchor_row", "anchor_id", "bound", "score", "id", "row"])

    return search


def _passes(packs: DataFrame) -> list[list[int]]:
    """First rows of the packs that go together in a pass."""
    passes, held = [], 0
    for first, values in packs.select("first", F.col("n") * F.col("width")).orderBy("first").toLocalIterator():
        if not passes or held + values > PASS_VALUES:
            passes, held = [*passes, []], 0
        passes[-1].append(first)
        held += values
    return passes


def _first(found: DataFrame, key: list[str], wanted: int) -> DataFrame:
    """The ``wanted`` best of all tasks' rows, numbered."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the best negatives.

    Vectors are ``floor(scale * x)`` in each component; a score is the integer inner product with the
    anchor, higher is better, ties by smaller id. An anchor's positives are its best other rows of its
    label; a positive's negatives are the best rows of other labels that score from ``least_percent`` of
    its score up to its score.

    - Rows with a null label or vector or a null or non-finite component take no part.
    - Rows that repeat are rows of their own: also one that repeats the anchor is a positive. Null ids come
      last and stay null; of equal ids and scores any order is stable in a run.
    - Of vectors of different lengths the shorter counts as filled up with zeros; an empty one scores 0.
    - A positive without such negatives (any of negative score, too) has no result row. Other columns are
      ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    small_batches(spark)
    all_rows = cut(usable(rows, id_col, vector_col, label_col, anchor, scale), "negatives-rows")
    # Equal vectors of one label score alike: a list can hold the first few of them only.
    copies = Window.partitionBy("label", "v").orderBy("id", "row")
    needed = all_rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= max(positives + 1, negatives))
    columns = ["row", "id", "label", "v"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = cut(needed.repartitionByRange(n, F.desc("squared"), "row").sortWithinPartitions(F.desc("squared"), "row").select(*columns)
                  .mapInArrow(_packed, _BUCKET_DDL), "negatives-buckets")
    packs = cut(all_rows.where("anchor").select(*columns).mapInArrow(_packed, _BUCKET_DDL), "negatives-anchors")

    results = []
    for firsts in _passes(packs):
        anchors = Anchors(packs.where(F.col("first").isin(firsts)).select("rows", "ids", "labels", "matrix", "kind", "n", "width").collect())
        shared = spark.sparkContext.broadcast((anchors, [[(-np.inf, _NO_ID)]] * len(anchors.rows)))
        near = cut(_first(buckets.mapInArrow(_search(shared, positives, True), _FOUND_DDL), ["anchor_row"], positives), "negatives-positives")
        # at most ``positives`` rows for each anchor of the pass
        scores: dict[int, set[int]] = {}
        for row, score in near.select("anchor_row", "score").collect():
            scores.setdefault(row, set()).add(score)
        bounds = [[(-(-s * least_percent // 100), s) for s in sorted(scores.get(row, ())) if s >= 0] for row in anchors.rows.tolist()]
        shared = spark.sparkContext.broadcast((anchors, bounds))
        hard = _first(buckets.mapInArrow(_search(shared, negatives, False), _FOUND_DDL), ["anchor_row", "bound"], negatives)
        results.append(near.select("anchor_row", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("bound")).join(
            cut(hard.select("anchor_row", "bound", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")),
                "negatives-found"), ["anchor_row", "bound"]))
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    empty = spark.createDataFrame([], "anchor_row long, bound long, anchor_id long, positive_id long, rank int, negative_id long, negative_score long")
    out = empty
    for found in results:
        out = out.unionByName(found) if out is not empty else found
    return out.select(known("anchor_id"), known("positive_id"), "rank", known("negative_id"), F.col("bound").alias("positive_score"), "negative_score")
