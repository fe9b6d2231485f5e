"""A training-corpus pipeline over documents: five stages, each of them one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
All stages but the last return the columns of documents. ``run`` applies them in order, writing each
stage's rows to the cluster's shared folder and rereading them, so that a lost executor costs one
stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, mixing, simhash, toxicity
from tidemark.llm.common import cut, free_name, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5; the model learns from all labels of documents still here."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < 0.5).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; those it does not take are gone."""
    return mixing.apply_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them again."""
    ids = bpe.encode(docs.select("doc_id", "source", "text"))
    back = bpe.decode(ids)
    return back.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding", tokenize),
]

#: SimHash components and learned scores can't be expressed in SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
