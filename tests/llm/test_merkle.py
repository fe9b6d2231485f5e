"""Merkle fingerprints and their likeness against a brute-force version."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
CHARS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def brute_print(text):
    written, digests = [], []
    for section in (text or "").split("\n\n"):
        own, names = [], []
        for paragraph in section.split("\n"):
            leaves = [md5(run) for sentence in re.findall("[^.!?。！？]+[.!?。！？]*|[.!?。！？]+", paragraph)
                      for run in re.findall(f"(?:(?:[{CHARS}]|[^ {CHARS}]{{1,64}}) *){{1,4}}| +", sentence)]
            names.append(md5("".join(leaves)))
            own.append(names[-1][:16] + "".join("." + x[:8] for x in leaves))
        digests.append(md5("".join(names)))
        written.append(digests[-1][:16] + ":" + ",".join(own))
    return md5("".join(digests)) + "-" + "|".join(written)


def brute_likeness(a, b):
    if a[:32] == b[:32]:
        return 1.0
    total, both = [1, 1], 0
    parts = [set(x[33:].split("|")) for x in (a, b)]
    for split in (lambda s: s[17:].split(","), lambda p: p.split(".")[1:], None):
        common = parts[0] & parts[1]
        for x in common:
            below = [] if split is None else split(x)
            weight = 1 + sum(1 + p.count(".") for p in below) if x.count(":") else 1 + x.count(".") if split else 1
            both += weight
            total = [t + weight for t in total]
        total = [t + len(p - common) for t, p in zip(total, parts)]
        if split:
            parts = [{y for x in p - common for y in split(x)} for p in parts]
    return 2 * both / sum(total)


def prints(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = merkle.with_fingerprints(frame, p=F.col("text")).collect()
    return [r["p"] for r in sorted(rows, key=lambda r: r["i"])]


def likeness(spark, pairs):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    rows = merkle.with_likeness(merkle.with_fingerprints(frame, x=F.col("a"), y=F.col("b")), near=("x", "y")).collect()
    return [r["near"] for r in sorted(rows, key=lambda r: r["i"])]


def test_query_against_brute_force(spark):
    texts = {i: t or "" for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()}
    ids = sorted(texts)
    rows = {r["doc_id"]: r for r in QUERIES["op4_merkle"](spark, SF).collect()}
    assert sorted(rows) == ids
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, r = texts[i], rows[i]
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + texts[following][:quarter]
        own, changed, other = map(brute_print, (text, edited, texts[following]))
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), own, changed)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(brute_likeness(own, changed)) and r["near_next"] == pytest.approx(brute_likeness(own, other))


def test_likeness_of_random_trees(spark):
    r = random.Random(6)
    def text():
        return "\n\n".join("\n".join(" ".join(r.choice("abcde") * 2 for _ in range(r.randint(0, 9))) for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 3)))
    pairs = [(text(), text()) for _ in range(200)]
    want = [brute_likeness(brute_print(a), brute_print(b)) for a, b in pairs]
    assert likeness(spark, pairs) == pytest.approx(want)


def test_order_scripts_and_edits_show(spark):
    chinese = "今天天气很好我们去公园散步然后回家吃饭。晚上看了一部电影非常有趣大家都很开心。" * 3
    swapped, edit, same, empty = likeness(spark, [
        ("a b c d\ne f g h", "e f g h\na b c d"), (chinese, chinese[:-10] + "完全不同的结尾在这里"), ("x", "x"), (None, "")])
    assert 0 < swapped < 1 and 0 < edit < 1 and same == empty == 1.0


def test_a_filled_template_never_collides(spark):
    n = 200_000
    texts = spark.range(n).select(F.concat(F.lit("number "), F.col("id")).alias("text"))
    rows = merkle.with_fingerprints(texts, p=F.col("text")).select(merkle.root(F.col("p")).alias("root"))
    assert rows.distinct().count() == n


def test_very_long_and_unsplit_texts(spark):
    long, unsplit = "word and word. " * 60_000, "x" * 300_000
    a, b, c = prints(spark, [long, unsplit, unsplit + "y"])
    assert a == brute_print(long) and b == brute_print(unsplit) and b[:32] != c[:32]
    assert likeness(spark, [(unsplit, unsplit + "y")])[0] < 1
