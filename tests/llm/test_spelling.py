"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling
from tidemark.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def counted(docs, slip, min_chars=7, min_count=2):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if slip and h % slip == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += 1
    return {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_brute_force(words, ratio=10):
    # only words that share a first or a last half can be near: all the same, no other pair is looked at twice
    rows = {}
    for w, n in words.items():
        around = [v for v in words if abs(len(v) - len(w)) < 2 and v != w and near(w, v)]
        best = min(around, key=lambda v: (-words[v], v), default=None)
        rows[w] = (best if best and words[best] >= ratio * n else None, n, len(around))
    def last(w):
        return last(rows[w][0]) if rows[w][0] else w
    return sorted((w, f, last(w), n, k, words[f] if f else None) for w, (f, n, k) in rows.items())


def variants(spark, docs, **options):
    rows = spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), **options).collect()
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in rows)


def test_query_matches_brute_force(spark):
    import duckdb

    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in QUERIES["op11_spelling_variants"](spark, SF).collect())
    assert got == by_brute_force(counted(docs, 31))


@pytest.mark.parametrize("seed", range(3))
def test_neighbours_of_runs_and_small_alphabets(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("aàb") for _ in range(rng.randint(1, 5))): rng.choice((1, 2, 2, 30)) for _ in range(140)}
    got = {r["word"]: (r["n_near"], r["best"]["near"], -r["best"]["less"])
           for r in spelling.neighbours(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    want = {}
    for w in words:
        if around := [v for v in words if v != w and near(w, v)]:
            best = min(around, key=lambda v: (-words[v], v))
            want[w] = (len(around), best, words[best])
    assert got == want


def test_chains_of_forms_lead_to_the_last(spark):
    steps = [("aaaaaaaa", 2), ("aaaaaaab", 20), ("aaaaaabb", 200), ("aaaaabbb", 2000)]
    docs = [(1, " ".join([w] * n)) for w, n in steps]
    rows = {r[0]: r[1:] for r in variants(spark, docs)}
    assert [rows[w][1] for w, _ in steps] == ["aaaaabbb"] * 4
    assert rows["aaaaaaaa"][0] == "aaaaaaab" and rows["aaaaabbb"][0] is None


def test_defined_cases(spark):
    long_text = "variante " * 30_000 + "xvariante " * 3
    docs = [(1, None), (2, ""), (3, "Ünïcode÷Wörter ÜNïCODE÷WöRTER"), (None, "varianté varianté"), (5, long_text), (5, long_text)]
    assert variants(spark, docs) == by_brute_force(counted(docs, None))
    assert variants(spark, docs, slip_every=2) == by_brute_force(counted(docs, 2))
    clashing = spark.createDataFrame([(1, "gleiche gleiche", 1, "x")], "doc_id long, text string, n long, word string")
    assert [r["word"] for r in spelling.variants(clashing).collect()] == ["gleiche"]
    assert variants(spark, []) == []


def test_terminator_in_a_word_is_an_error(spark):
    with pytest.raises(Exception, match="terminator"):
        spelling.neighbours(spark.createDataFrame([("a\x00b", 1)], "word string, n long")).collect()
