"""Mutation batches: FIXTURES edge rows, and the set-based scans against a
one-request-at-a-time interpreter on random batches (hot keys included)."""

import random
from decimal import Decimal

import pytest

from tidemark import schemas
from tidemark.operators import mutations
from tidemark.operators.keyed_scan import prefix_scan, drop_scan_partitioning

GOLD_SCHEMA = "account_id long, current_balance double, currency string"
DELTA_SCHEMA = "seq long, action string, account_id long, amount double"


def reqs(spark, rows):
    return spark.createDataFrame(rows, schemas.REQUEST)


def gold(spark, rows=()):
    return spark.createDataFrame(list(rows), GOLD_SCHEMA)


def judged(spark, requests, current=(), **scan):
    out = mutations.judge_mutations(reqs(spark, requests), gold(spark, current), **scan)
    return sorted(out.collect(), key=lambda r: r["seq"])


def test_mutations_on_empty_state(spark):
    rows = [(0, "insert", 1, 10.0, None), (1, "update", 1, 11.0, None), (2, "delete", 1, None, None),
            (3, "update", 1, 12.0, None), (4, "insert", 1, 13.0, "EUR")]
    got = judged(spark, rows)
    assert [r["op"] for r in got] == ["c", "u", "d", None, "c"]
    assert got[3]["reason"] == "not found"
    assert got[0]["currency"] == "USD" and got[1]["currency"] == "USD" and got[4]["currency"] == "EUR"
    assert got[2]["current_balance"] is None


def test_upsert_on_existing(spark):
    got = judged(spark, [(0, "insert", 7, 99.0, "GBP")], current=[(7, 1.0, "USD")])
    assert got[0]["op"] == "u" and got[0]["current_balance"] == 99.0 and got[0]["currency"] == "GBP"


def test_update_keeps_current_currency(spark):
    got = judged(spark, [(0, "update", 7, 5.0, "GBP")], current=[(7, 1.0, "EUR")])
    assert got[0]["op"] == "u" and got[0]["currency"] == "EUR"


def test_missing_balance_checked_first(spark):
    got = judged(spark, [(0, "insert", 1, None, None), (1, "update", 2, None, None), (2, "delete", 3, None, None)])
    assert [r["reason"] for r in got] == ["balance required", "balance required", "not found"]


def test_insert_if_absent(spark):
    r = reqs(spark, [(0, "insert", 7, 1.0, None), (1, "insert", 8, 2.0, None), (2, "insert", 8, 3.0, None)])
    out = mutations.insert_if_absent(r, gold(spark, [(7, 5.0, "USD")])).collect()
    assert [(x["account_id"], x["seq"]) for x in out] == [(8, 1)]


# --- sequential interpreters -------------------------------------------------

def interpret_mutations(requests, current):
    table = {k: (b, c) for k, b, c in current}
    out = {}
    for seq, action, key, balance, currency in sorted(requests, key=lambda r: r[0]):
        if action in ("insert", "update") and balance is None:
            out[seq] = ("balance required", None, None, None)
        elif action == "insert":
            cur = currency or "USD"
            out[seq] = (None, "u" if key in table else "c", balance, cur)
            table[key] = (balance, cur)
        elif action == "update":
            if key not in table:
                out[seq] = ("not found", None, None, None)
            else:
                cur = table[key][1]
                table[key] = (balance, cur)
                out[seq] = (None, "u", balance, cur)
        else:
            if key not in table:
                out[seq] = ("not found", None, None, None)
            else:
                del table[key]
                out[seq] = (None, "d", None, None)
    return out


def interpret_delta(requests, current):
    table = {k: Decimal(str(b)).quantize(Decimal("0.01")) for k, b, _ in current}
    out = {}
    for seq, action, key, amount in sorted(requests, key=lambda r: r[0]):
        amt = None if amount is None else Decimal(str(amount)).quantize(Decimal("0.01"))
        if action == "insert" and key not in table:
            table[key] = amt
            out[seq] = ("c", float(amt))
        elif action == "update" and key in table:
            table[key] = table[key] + amt
            out[seq] = ("u", float(table[key]))
        elif action == "delete" and key in table:
            del table[key]
            out[seq] = ("d", None)
    return out


def random_batch(rng, n, keys, hot_key=None):
    rows = []
    for seq in rng.sample(range(n * 3), n):
        key = hot_key if hot_key is not None and rng.random() < 0.4 else rng.randrange(keys)
        action = rng.choices(["insert", "update", "delete"], weights=[3, 5, 2])[0]
        balance = None if rng.random() < 0.1 else round(rng.uniform(0, 100), 2)
        currency = rng.choice(["USD", "EUR", None, ""])
        rows.append((seq, action, key, balance, currency))
    return rows


@pytest.mark.parametrize("ranges,gap", [(None, 1), (1, 1), (7, 1), (64, 1), (7, 10_000_000)])
def test_mutations_match_interpreter(spark, ranges, gap):
    rng = random.Random((ranges or 0) * 31 + gap)
    batch = [(r[0] * gap, *r[1:]) for r in random_batch(rng, 600, 12, hot_key=3)]
    current = [(k, round(rng.uniform(0, 50), 2), rng.choice(["USD", "EUR", None])) for k in range(0, 12, 2)]
    expected = interpret_mutations(batch, current)
    got = judged(spark, batch, current, ranges=ranges)
    assert len(got) == len(batch)
    for r in got:
        assert (r["reason"], r["op"], r["current_balance"], r["currency"]) == expected[r["seq"]], r


@pytest.mark.parametrize("ranges,gap", [(None, 1), (5, 1), (48, 10_000_000)])
def test_delta_fold_matches_interpreter(spark, ranges, gap):
    rng = random.Random(7 + (ranges or 0))
    rows = []
    for seq in (n * gap for n in rng.sample(range(2000), 500)):
        key = 1 if rng.random() < 0.4 else rng.randrange(10)
        action = rng.choices(["insert", "update", "delete"], weights=[2, 6, 1])[0]
        amount = round(rng.uniform(-20, 20), 2) if action == "update" else round(rng.uniform(0, 500), 2)
        rows.append((seq, action, key, amount if action != "delete" else None))
    current = [(k, round(rng.uniform(0, 50), 2), "USD") for k in range(0, 10, 3)]
    expected = interpret_delta(rows, current)
    out = mutations.delta_fold(
        spark.createDataFrame(rows, DELTA_SCHEMA), gold(spark, current), ranges=ranges
    ).collect()
    got = {r["seq"]: (r["op"], r["current_balance"]) for r in out}
    assert got == expected


def test_prefix_scan_null_key_group_and_sums(spark):
    rows = [(None, i, i if i % 3 else None) for i in range(20)] + [(1, i, 1) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, s long, v long")
    out = drop_scan_partitioning(
        prefix_scan(df, "k", "s", last_before={"lb": "v"}, last_upto={"lu": "v"}, running_sum={"rs": "v"},
                    ranges=6)
    ).collect()
    for r in out:
        prior = [v for k, s, v in rows if k == r["k"] and s < r["s"] and v is not None]
        upto = [v for k, s, v in rows if k == r["k"] and s <= r["s"] and v is not None]
        assert r["lb"] == (prior[-1] if prior else None)
        assert r["lu"] == (upto[-1] if upto else None)
        assert r["rs"] == sum(upto)


def test_action_must_match_exactly(spark):
    got = judged(spark, [(0, "INSERT", 1, 1.0, None), (1, "upsert", 1, 1.0, None), (2, "insert", None, 1.0, None)])
    assert [r["reason"] for r in got] == ["unsupported action", "unsupported action", "account_id required"]


def test_requests_need_a_position(spark):
    rows = [(None, "insert", 1, 1.0, None), (-3, "insert", 1, 1.0, None), (0, "update", 1, 2.0, None)]
    got = mutations.judge_mutations(reqs(spark, rows), gold(spark)).collect()
    reasons = {r["seq"]: r["reason"] for r in got}
    assert reasons[None] == "seq required" and reasons[-3] == "seq required"
    assert reasons[0] == "not found"  # the unplaced inserts did not create the account


def test_delta_fold_ignores_requests_without_key_or_position(spark):
    rows = [(0, "insert", None, 5.0), (1, "insert", 1, 10.0), (-1, "update", 1, 99.0), (2, "update", 1, 2.5)]
    out = mutations.delta_fold(spark.createDataFrame(rows, DELTA_SCHEMA), gold(spark)).collect()
    assert sorted((r["seq"], r["op"], r["current_balance"]) for r in out) == [(1, "c", 10.0), (2, "u", 12.5)]
