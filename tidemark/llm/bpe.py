"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

Texts of up to LEAF_CHARS are encoded where they lie. A longer text is cut into leaves without
looking for a good place; the leaves are encoded in parallel, wherever they are dealt to, and are
then joined in pairs up a tree. Around each join a window is encoded again and grows until its
left end and its right end agree with what both sides have:

- Between pre-tokens: the matcher that splits a text looks at nothing before its position and only
  one character past a match. All pre-tokens of the left side but those that touch the cut (or lie
  within the length of a special token) are final. From the last final one the window is split anew
  until it has a boundary that the right side has too; from there on both go on alike.
- Inside one unsplit pre-token: a sequence of tokens is the encoding of its bytes if each pair of
  neighbours is the encoding of theirs. A window whose first and last tokens equal those of the two
  sides therefore joins them exactly; until it does, it doubles.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, small_batches

LEAF_CHARS = 1 << 15

#: How byte-level BPE of this family splits texts before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    """The public 50k byte-level vocabulary installed on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves,
    the others for code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Piece:
    """A stretch of text, the ends of its pre-tokens (in characters), its tokens, and how many
    tokens lie before each of these ends."""

    text: str
    ends: np.ndarray
    counts: np.ndarray
    ids: np.ndarray

    def head(self, n: int) -> "Piece":
        """The first n pre-tokens."""
        k = int(self.counts[n - 1]) if n else 0
        return Piece(self.text[:int(self.ends[n - 1]) if n else 0], self.ends[:n], self.counts[:n], self.ids[:k])

    def tail(self, n: int) -> "Piece":
        """All but the first n pre-tokens."""
        if not n:
            return self
        e, k = int(self.ends[n - 1]), int(self.counts[n - 1])
        return Piece(self.text[e:], self.ends[n:] - e, self.counts[n:] - k, self.ids[k:])


def _chain(*pieces: Piece) -> Piece:
    ends, counts, at, k = [], [], 0, 0
    for p in pieces:
        ends.append(p.ends + at)
        counts.append(p.counts + k)
        at, k = at + len(p.text), k + len(p.ids)
    return Piece("".join(p.text for p in pieces), np.concatenate(ends), np.concatenate(counts),
                 np.concatenate([p.ids for p in pieces]))


class Codec:
    """Encoder and decoder over a vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or model["type"] != "BPE":
            raise ValueError(f"{path}: not a byte-level BPE without prefix space and normalizer")
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        if any(model["vocab"][m.replace(" ", "", 1)] != 256 + i for i, m in enumerate(merges)):
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        self.encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.longest_special = max(map(len, self.special), default=0)
        either = "|".join(map(regex.escape, self.special))
        self._special = regex.compile(f"({either})") if self.special else None
        self._pattern = regex.compile(PATTERN)

    def encode(self, text: str) -> list[int]:
        """Tokens of a text that is encoded as a whole."""
        return self.encoding.encode(text, allowed_special="all")

    def decode(self, ids) -> str:
        return self.encoding.decode(ids)

    def _split(self, text: str) -> list[str]:
        if not self._special or not any(s in text for s in self.special):
            return self._pattern.findall(text)
        parts = self._special.split(text)
        return [t for i, part in enumerate(parts) for t in ([part] if i % 2 else self._pattern.findall(part))]

    def _tokens(self, pretoken: str) -> list[int]:
        if pretoken in self.special:
            return [self.special[pretoken]]
        return self.encoding._core_bpe.encode_single_piece(pretoken.encode("utf-8"))

    def piece(self, text: str, known: dict[str, np.ndarray] | None = None) -> Piece:
        split = self._split(text)
        ids = [known[t] if known and t in known else self._tokens(t) for t in split]
        flat = np.concatenate([np.asarray(x, np.uint32) for x in ids]) if ids else np.zeros(0, np.uint32)
        return Piece(text, np.cumsum([len(t) for t in split], dtype=np.int64) if split else np.zeros(0, np.int64),
                     np.cumsum([len(x) for x in ids], dtype=np.int64) if ids else np.zeros(0, np.int64), flat)

    def join_tokens(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Tokens of one unsplit pre-token from those of its two parts."""
        k = 1
        while True:
            a, b = left[max(0, len(left) - k):], right[:k]
            window = self.encoding.decode_bytes([*a.tolist(), *b.tolist()])
            out = self.encoding._core_bpe.encode_single_piece(window)
            if (len(a) == len(left) or out[0] == a[0]) and (len(b) == len(right) or out[-1] == b[-1]):
                return np.concatenate([left[:len(left) - len(a)], np.asarray(out, np.uint32), right[len(b):]])
            k *= 2

    def join(self, left: Piece, right: Piece) -> Piece:
        """The encoding of left.text + right.text."""
        if not len(left.ends) or not len(right.ends):
            return right if not len(left.ends) else left
        margin = self.longest_special + 1  # white space before a special token splits by what follows it
        # the last boundary of the left side that neither the cut nor a special token across it can touch
        final = int(np.searchsorted(left.ends, len(left.text) - margin, side="right"))
        loose = left.tail(min(final, len(left.ends) - 1))
        kept = left.head(len(left.ends) - len(loose.ends))
        cut, take = len(loose.text), 2
        while True:
            head = right.head(min(take, len(right.ends)))
            whole = len(head.ends) == len(right.ends)
            a, b = loose.tail(len(loose.ends) - 1), right.head(1)
            known = {}
            if len(a.text) + len(b.text) > 64 and len(self._split(a.text + b.text)) == 1:
                # one unsplit stretch across the cut: its parts' tokens are joined, not made anew
                known = {a.text + b.text: self.join_tokens(a.ids, b.ids)}
            window = self.piece(loose.text + head.text, known)
            if whole:
                return _chain(kept, window)
            # boundaries of the window that its own end cannot touch, shared with the right side
            firm = window.ends[:-1]
            firm = firm[(firm >= cut + margin) & (firm <= len(window.text) - margin)]
            shared = firm[np.isin(firm - cut, head.ends)]
            if len(shared):
                n = int(np.searchsorted(window.ends, shared[0])) + 1
                m = int(np.searchsorted(right.ends, shared[0] - cut)) + 1
                return _chain(kept, window.head(n), right.tail(m))
            take *= 2

    def concatenate(self, pieces: list[Piece]) -> Piece:
        """Neighbours joined in pairs, level by level."""
        while len(pieces) > 1:
            pieces = [self.join(*pieces[i:i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
        return pieces[0]

    def encode_long(self, text: str, leaf_chars: int = LEAF_CHARS) -> list[int]:
        """The tree over one text, in one place."""
        leaves = [self.piece(text[i:i + leaf_chars]) for i in range(0, len(text), leaf_chars)]
        return self.concatenate(leaves).ids.tolist() if leaves else []


@cache
def codec(path: str) -> Codec:
    """One codec a process."""
    return Codec(path)


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None,
           leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` and its texts' token ids (array<int>), one row per input row, all columns kept.

    - A null or empty text has no tokens (an empty array).
    - Special tokens' strings in a text become their ids.
    - Very long texts are cut into leaves that are encoded in parallel; equal long texts (copies,
      repeated rows) are encoded once. Only texts over ``leaf_chars`` are shuffled.
    - An empty table gives an empty result. ``ids_col`` must not be a column already.
    """
    if ids_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column {ids_col} exists")
    path = path or default_path()
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def whole(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path)
        for batch in texts:
            yield pd.Series([np.asarray(c.encode(t or ""), np.int32) for t in batch], dtype=object)

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                at = range(0, len(text), leaf_chars)
                yield pd.DataFrame({"key": key, "i": range(len(at)), "leaf": [text[a:a + leaf_chars] for a in at]})

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for batch in batches:
            pieces = [c.piece(t) for t in batch["leaf"]]
            yield batch.assign(ends=[p.ends.tolist() for p in pieces], counts=[p.counts.tolist() for p in pieces],
                               ids=[p.ids.astype(np.int32) for p in pieces])

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        c, group = codec(path), group.sort_values("i")
        pieces = [Piece(t, np.asarray(e, np.int64), np.asarray(n, np.int64), np.asarray(x, np.uint32)) for t, e, n, x in zip(
            group["leaf"], group["ends"], group["counts"], group["ids"], strict=True)]
        return pd.DataFrame({"key": [group["key"].iloc[0]], "ids": [c.concatenate(pieces).ids.astype(np.int32)]})

    length = F.length(F.coalesce(F.col(text_col), F.lit("")))
    short = docs.where(length <= leaf_chars).withColumn(ids_col, whole(F.col(text_col)))
    key = free_name(docs, "_key")
    long = docs.where(length > leaf_chars).withColumn(key, F.sha2(F.col(text_col), 256))
    cut_up = long.select(F.col(key).alias("key"), F.col(text_col).alias("text")).mapInPandas(leaves, "key string, i int, leaf string")
    # a leaf of a text that occurs often is kept once, before and after the shuffle
    distinct = cut_up.groupBy("key", "i").agg(F.first("leaf").alias("leaf"))
    parts = distinct.mapInPandas(encoded, "key string, i int, leaf string, ends array<long>, counts array<long>, ids array<int>")
    trees = parts.groupBy("key").applyInPandas(joined, "key string, ids array<int>")
    found = long.join(trees, long[key] == trees["key"]).select(*[long[c] for c in docs.columns], trees["ids"].alias(ids_col))
    return short.unionByName(found)


def decode(df: DataFrame, ids_col: str = "ids", text_col: str = "decoded", digest_col: str | None = None,
           path: str | None = None) -> DataFrame:
    """``df`` and the text of its token ids; on request also the SHA-256 of the ids as little-endian
    unsigned 32-bit integers. Null ids decode to null; bytes that are no UTF-8 to replacement marks.
    Columns of the results' names must not be there yet."""
    taken = [c for c in (text_col, digest_col) if c and free_name(df, c) != c]
    if taken:
        raise ValueError(f"there is a column {taken[0]} already: name another one")
    path = path or default_path()
    small_batches(df.sparkSession)

    @F.pandas_udf("text string, digest string")
    def back(ids: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for batch in ids:
            yield pd.DataFrame({
                "text": [None if x is None else c.decode(np.asarray(x).tolist()) for x in batch],
                "digest": [None if x is None else hashlib.sha256(np.asarray(x).astype("<u4").tobytes()).hexdigest() for x in batch]})

    both = free_name(df, "_decoded")
    out = df.withColumn(both, back(F.col(ids_col))).withColumn(text_col, F.col(both)["text"])
    if digest_col:
        out = out.withColumn(digest_col, F.col(both)["digest"])
    return out.drop(both)
