"""SimHash near-duplicates with BK-trees.

Two fingerprints of 64 bits that differ in at most 3 agree in at least two of five bands (three
bits touch three bands at most). Each pair of bands, with the bits that it holds, names a shard;
every fingerprint goes to its ten shards, and fingerprints within the radius meet in one of them.

Each shard has a BK-tree: a node's children are keyed by their Hamming distance to it, and a
search within radius r of a query at distance d from the node follows the edges d-r to d+r only.
The trees are not broadcast whole: all of them together grow with the corpus. They are built by
the task that the shard is dealt to. A shard of more than TREE_ROWS fingerprints is cut into
blocks, a tree for each, and each pair of blocks is searched by a task of its own, so no task
holds more than one tree and no fingerprint misses one.

A task keeps only the links that join two parts of a shard not yet linked (a spanning forest);
components are then found over all shards by alternating star contractions in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, free_name, measured, named_ids, small_batches

SEED = 42
BANDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, bits
TREE_ROWS = 2048
_CHUNK = 1 << 16


def simhash(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """64-bit SimHash over word shingles of ``text``, repeats included; 0 without words.

    A-Z are lower-cased; words are separated by ASCII white space (bytes.split's). A bit is 1 if it
    is set in over half of the shingles' XXH64.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    n = max(1, len(words) - shingle + 1)
    last = end[shingle - 1:] if len(words) >= shingle else end[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in zip(start[:n].tolist(), last.tolist(), strict=True)], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        octets = hashes[i:i + _CHUNK].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint as signed 64-bit) of every row; map side only."""
    small_batches(docs.sparkSession)

    return named_ids(docs, id_col, text_col).select(F.col("_id").alias("doc_id"), _fingerprint_udf(shingle, seed)("_text").alias("fingerprint"))


class BKTree:
    """Fingerprints as nodes; a node's children by their Hamming distance to it."""

    def __init__(self) -> None:
        self.root: list | None = None  # [value, label, {distance: node}]

    def insert(self, value: int, label: int) -> None:
        if self.root is None:
            self.root = [value, label, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            child = node[2].get(d)
            if child is None:
                node[2][d] = [value, label, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Labels of the nodes at most ``radius`` from ``value``."""
        todo = [self.root] if self.root else []
        while todo:
            node_value, label, children = todo.pop()
            d = (node_value ^ value).bit_count()
            if d <= radius:
                yield label
            if children:
                low, high = d - radius, d + radius
                todo += [child for edge, child in children.items() if low <= edge <= high]


def _forest(tree_values: list[int], queries: list[int] | None, radius: int) -> Iterator[tuple[int, int]]:
    """Links within ``radius`` that join parts not linked before: among the tree's own values
    (queries None), or from each query to the tree's values."""
    values = tree_values + (queries or [])
    parent = list(range(len(values)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    tree = BKTree()
    if queries is not None:
        for label, value in enumerate(tree_values):
            tree.insert(value, label)
    first = 0 if queries is None else len(tree_values)
    for label in range(first, len(values)):
        for other in tree.within(values[label], radius):
            a, b = top(label), top(other)
            if a != b:
                parent[a] = b
                yield values[label], values[other]
        if queries is None:
            tree.insert(values[label], label)


def _shard_links(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(tree: list[int], queries: list[int], own: bool) -> Iterator[tuple[int, int]]:
        return _forest(tree, None, radius) if own else _forest(tree, queries, radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard and pair of blocks; one pair is held at a time."""
        at, tree, queries, out = None, [], [], []

        def flush():
            if at is not None and (len(tree) > 1 or queries):
                out.extend(links(tree, queries, at[-1] == at[-2]))

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("shard", "low", "high", "in_tree", "fingerprint")]
            for shard, low, high, in_tree, value in zip(*cols, strict=True):
                if at != (shard, low, high):
                    flush()
                    at, tree, queries = (shard, low, high), [], []
                (tree if in_tree else queries).append(value & 0xFFFFFFFFFFFFFFFF)
            if len(out) >= 4096:
                yield _links_batch(out, schema)
                out = []
        flush()
        yield _links_batch(out, schema)

    return run


def _links_batch(out: list[tuple[int, int]], schema: pa.Schema) -> pa.RecordBatch:
    pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)


def near_links(distinct: DataFrame, radius: int = 3, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(a, b) links between distinct fingerprints within ``radius`` <= 3 bits: not all pairs, but a
    spanning forest of each shard, so components over them equal components over all pairs."""
    if not 0 <= radius <= 3:
        raise ValueError("five bands, of which two are equal, cover a radius of 3 at most")
    small_batches(distinct.sparkSession)
    bands = [F.shiftrightunsigned("fingerprint", first).bitwiseAND(F.lit((1 << bits) - 1)) for first, bits in BANDS]
    shards = [
        F.lit(i * 5 + j).cast("long") * F.lit(1 << 26) + bands[i] * F.lit(1 << 13) + bands[j]
        for i in range(5) for j in range(i + 1, 5)]
    placed = distinct.select("fingerprint", F.explode(F.array(*shards)).alias("shard"))
    sizes = placed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1").select(
        "shard", F.ceil(F.col("n") / tree_rows).cast("int").alias("blocks"))
    shared = placed.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
    # block b is the tree of the pairs (b, b), (b, b+1), ..., and is searched in the pairs (0, b), ..., (b-1, b)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = shared.select("fingerprint", "shard", "block", other).select(
        "shard", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") <= F.col("other")).alias("in_tree"), "fingerprint")
    key = ["shard", "low", "high"]
    return dealt.repartition(*key).sortWithinPartitions(*key, "fingerprint").mapInArrow(
        _shard_links(radius), "a long, b long")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Alternating star contractions: each node's larger neighbours are linked to its smallest
    neighbour (large star), then its smaller ones (small star), until nothing changes; every edge
    then links a node with its component. Rounds grow with the logarithm of the longest path.
    """
    def stars(edges: DataFrame, larger: bool) -> DataFrame:
        if larger:
            both = edges.union(edges.select("b", "a")).toDF("u", "v")
        else:
            both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        best = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(best, "u")
        if larger:
            made = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            made = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(best.select("u", "m"))
        return made.where("a <> b").distinct()

    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        edges = cut(stars(stars(edges, larger=True), larger=False), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _fingerprint_udf(shingle: int, seed: int):
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            bits = np.fromiter((simhash(t, shingle, seed) for t in batch), np.uint64, len(batch))
            yield pd.Series(bits.view(np.int64))

    return of


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint, component_id, component) of every row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; component_id is the
    smallest doc_id reachable over links, the row's own included. ``component`` is one of the
    component's fingerprints, the same for all its rows.

    - Null, empty and white-space texts have fingerprint 0, linked like any other.
    - Copies and repeated rows share a fingerprint and a component; each row has its result row.
    - A null doc_id gets a result row too; component_id is null only if all ids of its component are.
    - Other columns are ignored. An empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    distinct = cut(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct")
    linked = components(near_links(distinct.select("fingerprint"), radius))
    placed = distinct.join(linked, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component"), "first_id")
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = placed.select("fingerprint", "component").join(smallest, "component")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             radius: int = 3, seed: int = SEED) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: one of its smallest doc_id.

    A component whose ids are all null keeps one of its rows; of repeated rows with the smallest
    id, one stays. All columns are unchanged.
    """
    found = cut(near_duplicates(docs, id_col, text_col, shingle, radius, seed), "components")
    smallest = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = cut(found.groupBy(F.col("doc_id").alias("keep")).agg(
        F.count("*").alias("rows"), F.max(smallest).alias("stays")).where("stays"), "near-ids")
    once = ids.where("rows = 1")
    alone = docs.join(once, docs[id_col].eqNullSafe(once["keep"]), "left_semi")
    # ids of several rows: only here the rows' fingerprints are needed to tell them apart
    several = measured(ids.where("rows > 1").select("keep"), "near-several", F.lit(16))
    mark, comp = free_name(docs, "_fingerprint"), free_name(docs, "_component")
    kept = found.where(smallest).groupBy("doc_id", "fingerprint").agg(F.max("component").alias("component"))
    rows = docs.join(several, docs[id_col].eqNullSafe(several["keep"]), "left_semi").withColumn(
        mark, _fingerprint_udf(shingle, seed)(F.col(text_col)))
    chosen = rows.join(kept, rows[id_col].eqNullSafe(kept["doc_id"]) & (rows[mark] == kept["fingerprint"])).select(
        *[rows[c] for c in docs.columns], kept["component"].alias(comp))
    return alone.unionByName(chosen.dropDuplicates([id_col, comp]).drop(comp))
