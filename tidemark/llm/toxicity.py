"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled texts trains the model: first a lexicon of words and word beginnings
that toxic texts have and others lack (counted in Spark), then, on features that lie densely in
every text (lexicon densities, second-person proximity, capitals, punctuation, obfuscation), boosted
regression trees with logistic loss, then a monotone map from margins to probabilities, fitted on
texts that the trees have not seen and weighted to the class shares of all labels. Scoring is one
pass over the documents, map side only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, small_batches

#: Bounds of the fit: labelled texts of each class, characters read of each (a random stretch of
#: longer ones), and terms of the lexicon.
SAMPLE_PER_CLASS = 4000
SAMPLE_CHARS = 20_000
LEXICON_TERMS = 4000

PREFIXES = (4, 5, 6)
_MIN_LOG_ODDS = 3.0

# Fixed value: words that address the reader, in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer sie ihnen tu te toi ton ta tes "
    "vous votre vos tú ti contigo tus usted ustedes vosotros vos os".split())

_LOOKALIKE = str.maketrans("013457@$!|", "oleastasil")
_EDGES = re.compile(r"^\W+|\W+$")
_INNER = re.compile(r"[^\W\d_][\W\d_]+(?=[^\W\d_])")
_RUNS = re.compile(r"(\w)\1{2,}")

#: What a token is, as bits.
HIT, HIDDEN, SECOND, CAPITAL, PUNCTUATED, SHOUTED, OBFUSCATED = (1 << i for i in range(7))
_CACHE_TOKENS = 300_000

FEATURES = (
    "log_words", "hits", "log_hits", "hit_density", "densest_50", "hidden_hits", "hits_near_second", "second_density",
    "capital_density", "punctuation_density", "shout_density", "obfuscation_density", "mean_word_length")


def plain(token: str) -> tuple[str, bool]:
    """The token in lower case without edges, look-alike signs, inner signs and drawn-out letters;
    and whether it hid letters in that way."""
    word = _EDGES.sub("", token.lower())
    if word.isalpha() and not _RUNS.search(word):
        return word, False
    clear = word.translate(_LOOKALIKE) if any(c.isalpha() for c in word) else word
    clear = _RUNS.sub(r"\1", re.sub(r"[\W\d_]+", "", clear))
    hidden = bool(_INNER.search(word) or _RUNS.search(word))
    return clear, hidden


class _Tokens(dict):
    """Token -> bits, kept for as long as it stays small."""

    def __init__(self, lexicon: frozenset[str]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        word, hidden = plain(token)
        bits = 0
        if any(term in self.lexicon for term in terms_of(word)):
            bits |= HIT | (HIDDEN if hidden else 0)
        if word in SECOND_PERSON:
            bits |= SECOND
        if len(token) > 1 and token.isupper():
            bits |= CAPITAL
        if not token.isalnum():
            bits |= PUNCTUATED
        if "!" in token or "?!" in token:
            bits |= SHOUTED
        if hidden:
            bits |= OBFUSCATED
        if len(self) >= _CACHE_TOKENS:
            self.clear()
        self[token] = bits
        return bits


def terms_of(word: str) -> list[str]:
    """What of a word may be in the lexicon: its beginnings (marked) and itself."""
    if len(word) < 3:
        return []
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) >= n]


def features(text: str | None, bits_of: _Tokens) -> np.ndarray:
    tokens = (text or "").split()
    n = len(tokens)
    if not n:
        return np.zeros(len(FEATURES))
    bits = np.fromiter(map(bits_of.__getitem__, tokens), np.int16, n)
    at = np.flatnonzero(bits & HIT)
    hits, densest, near = len(at), 0, 0
    if hits:
        densest = int((np.searchsorted(at, at + 50) - np.arange(hits)).max())
        you = np.flatnonzero(bits & SECOND)
        if len(you):
            i = np.searchsorted(you, at)
            left = np.abs(at - you[np.maximum(i - 1, 0)])
            right = np.abs(you[np.minimum(i, len(you) - 1)] - at)
            near = int((np.minimum(left, right) <= 5).sum())
    share = [float(np.count_nonzero(bits & b)) / n for b in (SECOND, CAPITAL, PUNCTUATED, SHOUTED, OBFUSCATED)]
    return np.array([math.log1p(n), hits, math.log1p(hits), hits / n, densest, np.count_nonzero(bits & HIDDEN), near,
                     *share, (len(text) - n + 1) / n])


@dataclass
class Trees:
    """Boosted regression trees on binned features, logistic loss."""

    rounds: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    l2: float = 1.0
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        at = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.concatenate([np.quantile(c, at), np.quantile(c[c > c.min()], at) if (c > c.min()).any() else []]))
                      for c in x.T]
        b = self._binned(x)
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(b, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += self._follow(b, tree)
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray):
        """A complete tree; node i has the children 2i+1 and 2i+2. A node that isn't worth a split
        sends all rows left."""
        inner = (1 << self.depth) - 1
        feature, cut, value = np.zeros(inner, int), np.full(inner, 1 << 30), np.zeros(1 << self.depth)
        node = np.zeros(len(g), int)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            best = 1e-6
            gs, hs = g[rows].sum(), h[rows].sum()
            for j in range(b.shape[1]):
                size = len(self.edges[j]) + 1
                gl = np.cumsum(np.bincount(b[rows, j], g[rows], size))[:-1]
                hl = np.cumsum(np.bincount(b[rows, j], h[rows], size))[:-1]
                if not len(gl):
                    continue
                gain = gl**2 / (hl + self.l2) + (gs - gl) ** 2 / (hs - hl + self.l2) - gs**2 / (hs + self.l2)
                i = int(np.argmax(gain))
                if gain[i] > best:
                    best, feature[k], cut[k] = float(gain[i]), j, i
            node[rows] = 2 * k + 1 + (b[rows, feature[k]] > cut[k])
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, len(value)), np.bincount(leaf, h, len(value))
        return feature, cut, -self.rate * gs / (hs + self.l2)

    def _follow(self, b: np.ndarray, tree) -> np.ndarray:
        feature, cut, value = tree
        node, rows = np.zeros(len(b), int), np.arange(len(b))
        for _ in range(self.depth):
            node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
        return value[node - len(feature)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        return self.base + sum((self._follow(b, t) for t in self.trees), np.zeros(len(x)))


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing map from margin to mean label (pool adjacent violators)."""
    xs, first = np.unique(margin, return_inverse=True)
    w = np.bincount(first, weight)
    m = np.bincount(first, weight * y) / w
    blocks: list[list[float]] = []  # mean, weight, first x, last x
    for x, mean, size in zip(xs, m, w, strict=True):
        blocks.append([mean, size, x, x])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            mean, size, _, last = blocks.pop()
            a = blocks[-1]
            a[0], a[1], a[3] = (a[0] * a[1] + mean * size) / (a[1] + size), a[1] + size, last
    knots = [(x, b[0]) for b in blocks for x in dict.fromkeys((b[2], b[3]))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


@dataclass
class Model:
    lexicon: frozenset[str]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]

    def scores(self, texts) -> np.ndarray:
        if not len(texts) or self.trees is None:
            return np.full(len(texts), self.knots[1][0])
        tokens = self.__dict__.setdefault("_tokens", _Tokens(self.lexicon))
        x = np.stack([features(t, tokens) for t in texts])
        return np.interp(self.trees.margin(x), *self.knots)


def _mined(sample: DataFrame) -> frozenset[str]:
    """Terms of toxic sample texts that others lack, strongest first, LEXICON_TERMS at most.

    Texts that are equal count once, so copies of one text can't make its words a lexicon.
    """
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not other:
        return frozenset()
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{3,}"), F.lit(0)))
    cuts = [F.transform(F.filter("words", lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")))
            for n in PREFIXES]
    terms = sample.select("toxic", words.alias("words")).select(
        "toxic", F.explode(F.array_distinct(F.concat("words", *cuts))).alias("term"))
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (other - F.col("b") + 0.5))
    best = (counts.where(F.col("a") >= max(4, toxic / 200)).withColumn("odds", odds).where(F.col("odds") >= _MIN_LOG_ODDS)
            .orderBy(F.desc(F.col("odds") * F.log1p("a")), "term").limit(LEXICON_TERMS))
    return frozenset(r["term"] for r in best.select("term").collect())


def training_rows(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_id: str,
                  label_col: str, per_class: int, chars: int) -> tuple[DataFrame, dict[int, int]]:
    """A sample of labelled texts (key, text, toxic), ``per_class`` of each class at most, and the
    number of all labels of each class. Labels are ranked by a hash of their id."""
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(train)
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for c in (0, 1):
        part = known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    n, at = F.length("text"), F.pmod(F.xxhash64("key"), F.greatest(F.length("text") - chars, F.lit(1)))
    # at most 2 x per_class ids
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .join(F.broadcast(chosen), "doc_id").withColumn("key", F.sha2("text", 256))
             .select("key", "toxic", F.when(n > chars, F.substring("text", at.cast("int") + 1, F.lit(chars))).otherwise(F.col("text")).alias("text")))
    once = texts.groupBy("key").agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    return once, totals


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS,
        chars: int = SAMPLE_CHARS) -> Model:
    """A model learned from at most ``per_class`` labelled texts of each class.

    ``train`` is a condition on ``doc_id``; labels outside it are not looked at. Null ids and labels
    other than 0 and 1 are ignored; an id labelled both ways counts as toxic. Without labelled texts of both
    classes every score is the share of toxic labels (0 without any).
    """
    from tidemark.llm.common import cut

    rows, totals = training_rows(docs, labels, F.lit(True) if train is None else train, id_col, text_col,
                                 label_id, label_col, per_class, chars)
    sample = cut(rows, "toxicity-sample")
    lexicon = _mined(sample.where(F.pmod(F.xxhash64("key"), F.lit(3)) != 0))
    small_batches(docs.sparkSession)

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = _Tokens(lexicon)
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "toxic": batch["toxic"],
                                "x": [features(t, tokens).tolist() for t in batch["text"]]})

    found = sample.mapInPandas(dense, "key string, toxic int, x array<double>").withColumn(
        "held", F.pmod(F.xxhash64("key"), F.lit(3)) == 0).orderBy("key").collect()
    y = np.array([r["toxic"] for r in found], float)
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    held = np.array([r["held"] for r in found], bool)
    if len(y) < 10 or not 0 < y[held].sum() < held.sum() or not 0 < y[~held].sum() < (~held).sum():
        return Model(lexicon, None, (np.zeros(1), np.array([share])))
    x = np.array([r["x"] for r in found])
    trees = Trees().fit(x[~held], y[~held])
    # the sample has the classes in other shares than the labels have
    per_row = np.where(y > 0, totals[1] / y.sum(), totals[0] / (len(y) - y.sum()))
    return Model(lexicon, trees, isotonic(trees.margin(x[held]), y[held], per_row[held]))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` and each row's probability of label 1 (0 to 1), all columns kept; a column named
    ``score_col`` must not be there yet.

    Null and empty texts get the score of a text without words. Rows depend on nothing but their
    text, so repeated rows score alike; an empty table gives an empty result.
    """
    if free_name(docs, score_col) != score_col:
        raise ValueError(f"there is a column {score_col} already: name another one")
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.scores(batch))

    return docs.withColumn(score_col, of(F.col(text_col)))
