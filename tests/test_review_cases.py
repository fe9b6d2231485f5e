"""Requests, balances and settings that must not be lost, crash or be taken on trust."""

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import audit, mutations
from tidemark.session import require_local
from tidemark.sources import feed as feeds

GOLD = "account_id long, current_balance double, currency string, transaction_timestamp string"


def gold_of(spark, *rows):
    return spark.createDataFrame(list(rows), GOLD)


def test_every_request_gets_one_verdict(spark):
    requests = spark.createDataFrame(
        [(0, None, 1, 1.0, None), (1, "seed", 1, 500.0, None), (2, "grow", 1, 1.0, None), (3, "update", 1, 7.0, None),
         (4, None, None, None, None), (None, "insert", 1, 1.0, None)], schemas.REQUEST)
    judged = {r["seq"]: r for r in mutations.judge_mutations(requests, gold_of(spark, (1, 10.0, "EUR", None))).collect()}
    assert len(judged) == 6
    assert [judged[i]["reason"] for i in (0, 1, 2)] == [mutations.REASON_ACTION] * 3
    assert (judged[3]["reason"], judged[3]["op"], judged[3]["currency"]) == (None, "u", "EUR")
    assert judged[4]["reason"] == mutations.REASON_KEY and judged[None]["reason"] == mutations.REASON_SEQ


def test_fold_ignores_foreign_actions_and_missing_amounts(spark):
    requests = spark.createDataFrame(
        [(0, "seed", 1, 500.0), (1, "update", 1, 1.0), (2, None, 1, 9.0), (3, "update", 1, None),
         (0, "insert", 2, 10.0), (1, "delete", 2, None), (2, "insert", 2, None), (3, "update", 2, 1.0)],
        "seq long, action string, account_id long, amount double")
    rows = mutations.delta_fold(requests, gold_of(spark, (1, 10.0, "USD", None))).collect()
    assert {(r["account_id"], r["seq"]): (r["op"], r["current_balance"]) for r in rows} == {
        (1, 1): ("u", 11.0), (2, 0): ("c", 10.0), (2, 1): ("d", None)}


def test_overflowing_balance_is_a_difference(spark):
    source = gold_of(spark, (1, 5e12, "USD", "2024-01-01"), (2, 1.0, "USD", "2024-01-01"), (3, None, "USD", "2024-01-01"))
    gold = gold_of(spark, (1, 5e12, "USD", "2024-01-01"), (2, 1.0, "USD", "2024-01-01"), (3, 5e12, "USD", "2024-01-01"))
    status = {r["account_id"]: r["status"] for r in audit.reconcile(source, gold).collect()}
    assert status == {1: "value_diff", 2: "match", 3: "value_diff"}


def test_cluster_must_name_its_shared_folder():
    for master in ("local", "local[8]", "local[*]", "local[8,4]"):
        require_local(master)
    for master in ("local-cluster[3,2,3000]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError):
            require_local(master)


def test_feed_offsets_never_meet():
    """On time, late, redelivered and junk records keep apart for every lsn below the shift."""
    top = 10**10
    spans = [(0, top), (feeds.LATE_SHIFT, feeds.LATE_SHIFT + top), (feeds.REDELIVER_SHIFT, feeds.REDELIVER_SHIFT + top),
             (feeds.JUNK_SHIFT, feeds.JUNK_SHIFT + top)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_unreadable_table_is_an_error_not_empty(spark, workdir):
    from tidemark.sources.tables import read_silver

    with open(workdir + "/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        read_silver(spark, workdir).select(F.sum("source_commit_lsn")).collect()
