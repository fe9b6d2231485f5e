"""Reconciliation by digests: the rows of the full join, joined only where the sides differ."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit

SOURCE = "account_id long, current_balance decimal(14,2), currency string, transaction_timestamp timestamp"
GOLD = "account_id long, current_balance double, currency string, transaction_timestamp string"


def tables(spark, n=3000):
    at = F.timestamp_seconds(F.col("id") * 60)
    source = spark.range(n).select("id", (F.col("id") % 97 / 4).cast("decimal(14,2)").alias("current_balance"),
                                   F.when(F.col("id") % 5 > 0, "USD").alias("currency"), at.alias("transaction_timestamp")).withColumnRenamed("id", "account_id")
    gold = source.withColumns({"current_balance": F.col("current_balance").cast("double"),
                               "transaction_timestamp": F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")})
    return source, gold


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("bits", [1, 6, 16])
def test_equals_the_full_join(spark, bits):
    source, gold = tables(spark)
    k = F.col("account_id")
    gold = gold.where(~k.isin(3, 1500)).withColumns({
        "current_balance": F.when(k == 10, 0.1).when(k == 11, None).when(k == 12, 1e15).otherwise(F.col("current_balance")),
        "currency": F.when(k == 20, "EUR").otherwise(F.col("currency")), "transaction_timestamp": F.when(k == 30, "nope").otherwise(F.col("transaction_timestamp"))})
    odd = spark.createDataFrame([(None, 1.0, "USD", None), (9999, None, None, None), (9998, 1e15, None, None)], GOLD)
    gold = gold.unionByName(odd)
    source = source.unionByName(spark.createDataFrame([(None, None, "USD", None), (9998, None, None, None)], SOURCE))
    want, got = audit.reconcile(source, gold), audit.reconcile_by_digest(source, gold, bits=bits)
    assert got.columns == want.columns and same(got, want)
    assert got.groupBy("status").count().count() == 4


def test_joins_only_ranges_that_differ(spark):
    source, gold = tables(spark)
    gold = gold.withColumn("current_balance", F.when(F.col("account_id").isin(5, 77), 0.25).otherwise(F.col("current_balance")))
    s, g = audit._bucketed(audit._source_side(source, "account_id"), "_k", 12), audit._bucketed(audit._gold_side(gold, "account_id"), "_kg", 12)
    differ = audit.differing_buckets(audit._digests(s, "source", "_k"), audit._digests(g, "gold", "_kg"), 12)
    assert differ.count() == 2
    assert s.join(differ, "_bucket", "left_semi").count() <= 8  # of 3,000
    equal = audit.differing_buckets(audit._digests(s, "source", "_k"), audit._digests(s, "source", "_k"), 12)
    assert equal.count() == 0


def test_empty_sides(spark):
    source, gold = tables(spark, 40)
    assert audit.reconcile_by_digest(source.limit(0), gold.limit(0)).count() == 0
    assert {r["status"] for r in audit.reconcile_by_digest(source, gold.limit(0)).collect()} == {"source_only"}
    assert {r["status"] for r in audit.reconcile_by_digest(source, gold).collect()} == {"match"}
    with pytest.raises(ValueError, match="bits"):
        audit.reconcile_by_digest(source, gold, bits=40)
