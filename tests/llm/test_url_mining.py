"""Mined URL rules against a brute-force version, and on URLs that would make exponentially many item sets."""

import random
import time
from itertools import combinations

from pyspark.sql import functions as F

from tidemark.llm import url_filter


def brute_rules(baskets, least_rows, min_confidence):
    """{items: (confidence, support)} of (tokens, bad) rows, items named by the first of tokens with equal rows."""
    rows_of = {}
    for i, (tokens, _) in enumerate(baskets):
        for t in tokens:
            rows_of.setdefault(t, set()).add(i)
    first = {}
    for t in sorted(rows_of):
        first.setdefault(frozenset(rows_of[t]), t)
    items = {name: rows for rows, name in first.items()}
    bad = {i for i, (_, b) in enumerate(baskets) if b}
    found = {}
    for k in range(1, len(items) + 1):
        for combo in combinations(sorted(items), k):
            rows = frozenset.intersection(*(items[c] for c in combo))
            hits = len(rows & bad)
            if hits >= least_rows and hits / len(rows) >= min_confidence and hits / len(rows) > len(bad) / len(baskets):
                found[combo] = (hits / len(rows), hits / len(baskets))
    return {c: v for c, v in found.items() if not any(set(p) < set(c) and found[p][0] >= v[0] for p in found)}


def test_rules_match_brute_force(spark):
    r = random.Random(2)
    urls = [(f"http://{r.choice(['a', 'b'])}.{r.choice(['org', 'net'])}/{r.choice(['x', 'y', 'z'])}?{r.choice(['p=1', 'p=2'])}&s=1",) for _ in range(120)]
    labelled = [(u, ("/x" in u and "p=1" in u) or (".net" in u and r.random() < 0.6)) for (u,) in urls]
    frame = spark.createDataFrame([*labelled, (None, True), ("http://a.org/x", None)], "url string, bad boolean")
    tokens = {x["url"]: x["t"] for x in spark.createDataFrame(urls, "url string").select("url", url_filter.tokens_of(F.col("url")).alias("t")).collect()}
    got = {tuple(x["items"]): (round(x["confidence"], 9), round(x["support"], 9)) for x in url_filter.mine(frame, min_support=0.05, min_rows=5).collect()}
    want = brute_rules([(tokens[u], b) for u, b in labelled], 0.05 * len(labelled), 0.5)
    assert got == {k: (round(c, 9), round(s, 9)) for k, (c, s) in want.items()} and got


def test_thirty_shared_items_take_seconds(spark):
    shared = "&".join(f"k{i}=v{i}" for i in range(30))
    labelled = spark.createDataFrame([(f"https://spam.info/{'w' * (i % 7 + 1)}?{shared}", True) for i in range(40)]
                                     + [(f"https://good.info/{'r' * (i % 7 + 1)}", False) for i in range(40)], "url string, bad boolean")
    started = time.perf_counter()
    rules = url_filter.mine(labelled)
    got = [(r["items"], len(r["members"][0])) for r in rules.collect()]
    assert time.perf_counter() - started < 60
    assert len(got) == 1 and got[0][1] >= 31  # the query items and the host say the same
    # any of its tokens stands for the item
    urls = spark.createDataFrame([("https://spam.info/else",), ("https://other.info/?k7=v7",), ("https://good.info/r",), ("",)], "url string")
    assert {x["url"] for x in url_filter.match(urls, rules).collect()} == {"https://spam.info/else", "https://other.info/?k7=v7"}


def test_long_urls(spark):
    long = "http://h.org/" + "/".join(f"s{i}" for i in range(3000))
    pages = spark.createDataFrame([(i, long) for i in range(12)] + [(50, "http://h.net/a")], "page_id long, url string")
    labelled = pages.where("page_id < 12").select("url", F.lit(True).alias("bad")).unionByName(
        spark.createDataFrame([(f"http://g.net/{c}", False) for c in "abcdefghijkl"], "url string, bad boolean"))
    got = {r["page_id"]: r for r in url_filter.judge(pages, [("net/", "block")], labelled).collect()}
    assert got[0]["verdict"] == "block" and got[0]["path"].endswith("/s2999") and got[50]["rule"] == "net/"
