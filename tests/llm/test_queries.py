"""Registered queries over the small tables, and the pipeline against its brute-force parts."""

import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return {r[0]: r[1:] for r in duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_folds_and_scores(spark, documents):
    for name, n, k in (("op6_language_id", 3, 1), ("op10_toxicity", 5, 0)):
        rows = QUERIES[name](spark, SF).collect()
        assert len(rows) == len(documents)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % n == k) and 0 <= r["score"] <= 1 for r in rows)


def test_languages_held_out(spark, documents):
    rows = [r for r in QUERIES["op6_language_id"](spark, SF).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == documents[r["doc_id"]][1] for r in rows) >= 0.9 * len(rows)


def test_native_plans_have_no_python(spark):
    for name in ("op1_url_filter", "op2_mixing", "op3_exact_dedup", "op4_merkle", "op8_line_dedup", "op12_chat_format"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan), name


def test_pages_equal_their_articles(spark):
    got = {r["page_id"]: r["text"] for r in QUERIES["op9_html_extraction"](spark, SF).collect()}
    import html

    for i, source in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?(b|br)>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[i] == "\n".join(b for b in blocks if b)


def test_pipeline(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        assert after.join(before, docs.columns, "left_anti").count() == 0, name  # rows come from the stage before
        if name == "exact dedup":
            texts = [r["text"] for r in after.collect()]
            assert len(texts) == len(set(texts)) and set(texts) == {r["text"] for r in before.collect()}
        before = after
    out = corpus_pipeline.run(spark, SF)
    assert out.where(~F.col("round_trip")).count() == 0
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in before.collect())
