"""Each stage of the corpus pipeline against a brute-force version over what the stage before kept."""

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_operators import brute_components, brute_simhash
from tidemark.llm import bpe, toxicity
from tidemark.llm.catalog import ORACLE
from tidemark.llm.common import cut

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = docs.orderBy(F.length("text").desc()).first()
    near = spark.createDataFrame([(10**6, long["text"] + " word", long["lang"], long["source"], long["n_chars"])], docs.schema)
    docs = cut(docs.unionByName(near), "test")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    every = docs.collect()
    calm = [r for r, s in zip(every, model.scores([r["text"] for r in every]), strict=True) if s < 0.5]
    kept = cut(STAGES["toxicity"](spark, docs, SF), "test")
    assert rows_of(kept) == sorted(map(tuple, calm), key=str) and len(calm) < len(every)

    last = {}
    for r in calm:
        last[r["text"] or ""] = max(r, last.get(r["text"] or "", r), key=lambda x: x["doc_id"])
    kept = cut(STAGES["exact dedup"](spark, kept, SF), "test")
    assert rows_of(kept) == sorted(map(tuple, last.values()), key=str)

    own = kept.collect()
    label = brute_components([brute_simhash(r["text"]) for r in own])
    smallest = {}
    for r, k in zip(own, label, strict=True):
        smallest[k] = min(r, smallest.get(k, r), key=lambda x: x["doc_id"])
    kept = cut(STAGES["SimHash near-dedup"](spark, kept, SF), "test")
    assert rows_of(kept) == sorted(map(tuple, smallest.values()), key=str) and len(smallest) < len(own)

    con = duckdb.connect()
    con.register("documents", kept.toPandas())
    copies = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, copies FROM ({ORACLE['op2_mixing']})").fetchall()}
    want = [tuple(r) for r in kept.collect() for _ in range(copies[r["doc_id"]])]
    kept = cut(STAGES["mixing sources"](spark, kept, SF), "test")
    assert rows_of(kept) == sorted(want, key=str)

    public = Tokenizer.from_file(bpe.default_path())
    for r in STAGES["BPE encoding"](spark, kept, SF).join(kept.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r["ids"] == public.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"]) and r["round_trip"]


ROWS = [(1, None, "en", "a", None), (2, "", "en", None, 0), (2, "two words", None, "b", 9), (None, "two words", "de", "b", 9), (None, None, None, None, None),
        (5, "long " * 40_000, "en", "c", 1), (5, "long " * 40_000, "en", "c", 1), (6, "é" * 5, "fr", "c", 5)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("empty", [False, True])
def test_awkward_documents(spark, name, empty):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = docs.withColumns({"score": F.lit(1), "_id": F.lit(2), "h": F.lit(3), "copies": F.lit(4), "Component_id": F.lit(5), "keep": F.lit(6)})
    given = clashing.limit(0) if empty else clashing
    out = STAGES[name](spark, given, SF)
    rows = out.collect()
    assert (len(rows) == 0) == empty
    if name != "BPE encoding":
        assert out.columns == clashing.columns
        assert {str(r["text"]) for r in rows} <= {str(r[1]) for r in ROWS}
    else:
        assert len(rows) == len(ROWS) * (not empty) and all(r["round_trip"] for r in rows)
    if name == "exact dedup" and not empty:
        assert sorted((r["text"] or "")[:9] for r in rows) == ["", "long long", "two words", "é" * 5]


def test_run_over_empty_tables(spark, workdir):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{workdir}/{t}.parquet")
    assert corpus_pipeline.run(spark, workdir).count() == 0
