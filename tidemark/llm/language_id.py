"""Language identification by a convolutional network over bytes.

Text becomes windows of WINDOW bytes; filters of several widths slide over each window, the largest
answer of each filter is kept, and a softmax names the language. The network is trained in numpy on a
bounded sample of labelled texts. When predicting, the filters' answers to single bytes and byte
pairs are tabulated, so a window costs a few table look-ups a byte; a text's prediction is the mean
over all its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, small_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNDETERMINED = "und"

#: Bounds of the fit: labelled texts of each language and (of many languages, shared out evenly) in all,
#: windows of each text. Every language of the labelled texts is learned.
TEXTS_PER_LANG = 800
TEXTS = 160_000
WINDOWS_PER_TEXT = 2
EPOCHS = 5
SEED = 5

_LETTER = regex.compile(r"\p{L}")
_BATCH_WINDOWS = 512


def windows(text: str, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The text's bytes (lower case, UTF-8) in windows, the last one padded with 0; bytes in each."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(raw) // size))
    out = np.zeros(n * size, np.uint8)
    out[:len(raw)] = raw
    return out.reshape(n, size), np.minimum(size, len(raw) - size * np.arange(n)).astype(float)


@dataclass
class Network:
    langs: list[str]
    params: dict[str, np.ndarray]

    @classmethod
    def new(cls, langs: list[str], seed: int = SEED) -> "Network":
        r = np.random.default_rng(seed)
        p = {"embed": r.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)}
        for w in WIDTHS:
            p[f"conv{w}"] = r.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)).astype(np.float32)
            p[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        p["out"] = r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        p["base"] = np.zeros(len(langs), np.float32)
        return cls(langs, p)

    def _forward(self, x: np.ndarray):
        p, e = self.params, self.params["embed"][x]
        pooled, trace = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            cols = np.concatenate([e[:, j:j + n] for j in range(w)], axis=2)
            z = cols @ p[f"conv{w}"] + p[f"bias{w}"]
            at = z.argmax(axis=1)
            pooled.append(np.maximum(np.take_along_axis(z, at[:, None], 1)[:, 0], 0))
            trace.append((cols, at))
        h = np.concatenate(pooled, axis=1)
        return h, trace, _softmax(h @ p["out"] + p["base"])

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED, rate: float = 0.01) -> "Network":
        """Adam on cross entropy; gradients flow through each filter's largest answer only."""
        r, p = np.random.default_rng(seed), self.params
        m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            for rows in np.array_split(r.permutation(len(x)), max(1, len(x) // 32)):
                bx, by = x[rows], y[rows]
                h, trace, q = self._forward(bx)
                d = q.copy()
                d[np.arange(len(rows)), by] -= 1
                d /= len(rows)
                g = {"out": h.T @ d, "base": d.sum(0), "embed": np.zeros_like(p["embed"])}
                dh = (d @ p["out"].T) * (h > 0)
                for i, (w, (cols, at)) in enumerate(zip(WIDTHS, trace, strict=True)):
                    dz = dh[:, i * FILTERS:(i + 1) * FILTERS]
                    picked = np.take_along_axis(cols, at[:, :, None], 1)  # rows x filters x (w * embedding)
                    g[f"conv{w}"] = np.einsum("bf,bfk->kf", dz, picked)
                    g[f"bias{w}"] = dz.sum(0)
                    back = dz[:, :, None] * p[f"conv{w}"].T[None]
                    for j in range(w):
                        byte = np.take_along_axis(bx, at + j, 1)
                        np.add.at(g["embed"], byte, back[:, :, j * EMBEDDING:(j + 1) * EMBEDDING])
                step += 1
                for k in p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def tables(self) -> list[list[tuple[int, int, np.ndarray]]]:
        """For each width: (offset, bytes, answers) of tables whose sum is the filters' answer."""
        p, out = self.params, []
        for w in WIDTHS:
            single = [p["embed"] @ p[f"conv{w}"][j * EMBEDDING:(j + 1) * EMBEDDING] for j in range(w)]
            single[0] = single[0] + p[f"bias{w}"]
            parts = [(j, 2, (single[j][:, None] + single[j + 1][None]).reshape(-1, FILTERS)) for j in range(0, w - 1, 2)]
            if w % 2:
                parts.append((w - 1, 1, single[w - 1]))
            out.append([(j, n, np.ascontiguousarray(t, np.float32)) for j, n, t in parts])
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each window, by the tables (the same answers as _forward's)."""
        tables = self.__dict__.setdefault("_tables", self.tables())
        out = []
        for i in range(0, len(x), _BATCH_WINDOWS):
            b = x[i:i + _BATCH_WINDOWS]
            pair = (b[:, :-1].astype(np.int32) << 8) | b[:, 1:]
            pooled = []
            for w, parts in zip(WIDTHS, tables, strict=True):
                n = b.shape[1] - w + 1
                z = None
                for j, size, t in parts:
                    got = t.take((pair if size == 2 else b)[:, j:j + n], axis=0)
                    z = got if z is None else np.add(z, got, out=z)
                pooled.append(np.maximum(z.max(axis=1), 0))
            out.append(_softmax(np.concatenate(pooled, axis=1) @ self.params["out"] + self.params["base"]))
        return np.concatenate(out)

    def predict(self, texts) -> tuple[list[str], list[float]]:
        """Language and probability of each text; all windows of all texts go through in batches."""
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        total: dict[int, np.ndarray] = {}

        def flush() -> None:
            if held:
                p = self.probabilities(np.concatenate([w for _, w, _ in held]))
                p *= np.concatenate([n for _, _, n in held])[:, None]
                at = 0
                for i, w, _ in held:
                    total[i] = total.get(i, 0) + p[at:at + len(w)].sum(axis=0)
                    at += len(w)
                held.clear()

        rows = 0
        for i, text in enumerate(texts):
            if not self.langs or text is None or not _LETTER.search(text):
                continue
            x, n = windows(text)
            for k in range(0, len(x), _BATCH_WINDOWS):
                held.append((i, x[k:k + _BATCH_WINDOWS], n[k:k + _BATCH_WINDOWS]))
                rows += len(held[-1][1])
                if rows >= _BATCH_WINDOWS:
                    flush()
                    rows = 0
        flush()
        for i, p in total.items():
            best = int(p.argmax())
            langs[i], scores[i] = self.langs[best], float(min(1.0, p[best] / p.sum()))
        return langs, scores


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", texts_per_lang: int = TEXTS_PER_LANG, windows_per_text: int = WINDOWS_PER_TEXT,
        all_texts: int = TEXTS) -> Network:
    """A network learned from at most ``texts_per_lang`` texts of each language, and ``all_texts`` divided by
    the number of languages (but one at least), ``windows_per_text`` stretches of each.
    Texts are chosen by a hash of id and text.

    ``train`` is a condition on ``doc_id``. Rows with a null language or a text without letters are
    ignored; without any rows the network knows no language and answers ``und`` with score 0.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows if train is None else rows.where(train)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    langs = sorted(r["lang"] for r in counts)
    network = Network.new(langs)
    if not langs:
        return network
    each = max(1, min(texts_per_lang, all_texts // len(langs)))
    # a hash threshold for each language keeps about twice as many texts as wanted, of which the first stay
    bounds = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 2 * each / r["n"])) for r in counts], "lang string, share double")
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32))
    n = F.length("text")
    starts = [F.pmod(F.xxhash64(F.lit(i), "text"), F.greatest(n - WINDOW // 2, F.lit(1))).cast("int") + 1 for i in range(windows_per_text)]
    sample = rows.join(F.broadcast(bounds), "lang").where(drawn < F.col("share") * float(1 << 32)).select(  # a row for each language
        "lang", drawn.alias("drawn"), F.xxhash64("doc_id", "text").alias("h"),
        F.array(*[F.substring("text", s, F.lit(WINDOW)) for s in starts]).alias("stretches"))
    first = Window.partitionBy("lang").orderBy("drawn", "h")
    sample = sample.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= each).drop("nth", "drawn")
    found = sorted(sample.collect(), key=lambda r: (r["h"], r["lang"]))
    index = {lang: i for i, lang in enumerate(langs)}
    pairs = [(windows(t)[0][0], index[r["lang"]]) for r in found for t in r["stretches"] if t and _LETTER.search(t)]
    if pairs:
        network.fit(np.stack([x for x, _ in pairs]), np.array([y for _, y in pairs]))
    return network


def identify(docs: DataFrame, network: Network, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` and struct(lang_pred, score) of each row's whole text, however long, all columns kept.

    A column named ``out_col`` must not be there yet. A null text, or one without a letter, gets ``und`` and score 0. Repeated rows get equal results.
    """
    if free_name(docs, out_col) != out_col:
        raise ValueError(f"there is a column {out_col} already: name another one")
    small_batches(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            langs, scores = network.predict(list(batch))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return docs.withColumn(out_col, of(F.col(text_col)))
