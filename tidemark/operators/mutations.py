"""Set-based mutation batches against current state.

A batch is a table of requests with an explicit position ``seq`` (>= 0, unique per
key). Each request is judged as if the batch were applied one request at a time in
``seq`` order on top of the current state (gold), but the whole batch is one Spark
job: per-key sequential state is a prefix scan (:mod:`.keyed_scan`), seeded by a
virtual row at ``seq = -1`` for every requested key that exists in gold.

M1 ``apply_mutations`` (upsert form):
  * insert: rejected "balance required" without a balance; otherwise an upsert:
    ``c`` if the key is absent, ``u`` if present; currency defaults to USD;
  * update: rejected "balance required" without a balance (checked first), then
    "not found" if absent; otherwise ``u`` with the new balance, currency unchanged;
  * delete: "not found" if absent, otherwise ``d`` (balance is ignored).
M2 ``delta_fold``: insert-if-absent with a base balance, update adds a delta to the
  current balance, delete removes; requests that find the wrong state are no-ops.
M3 ``insert_if_absent``: first insert per key, only for keys not in current state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import shared_dir
from .keyed_scan import drop_scan_partitioning, prefix_scan, set_or_add
from .state import KEY

# Request actions, event op codes, rejection reasons, default currency.
INSERT, UPDATE, DELETE = "insert", "update", "delete"
DEFAULT_CURRENCY = "USD"
REASON_BALANCE = "balance required"
REASON_NOT_FOUND = "not found"
REASON_ACTION = "unsupported action"
REASON_KEY = "account_id required"
REASON_SEQ = "seq required"  # position must be >= 0 (the current state sits at -1)
VIRTUAL = "_virtual"  # marks the rows that carry current state; requests never have it

EXACT = "decimal(20,2)"  # exact money arithmetic for folds


def _requested_state(requests: DataFrame, gold: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Gold rows of the keys the batch touches (at most one per requested key).

    A semi join: nothing is broadcast blindly; AQE broadcasts the request keys only
    when they measure small. Written once to the shared folder so that resolving
    gold (a window over all of silver) runs once per batch, not once per use.
    """
    keys = requests.select(key).where(F.col(key).isNotNull()).distinct()
    state = gold.select(key, *columns).join(keys, key, "left_semi")
    shared_dir(state.sparkSession)
    return state.checkpoint(eager=True)


def _currency_or_default(c) -> F.Column:
    return F.coalesce(F.when(c != "", c), F.lit(DEFAULT_CURRENCY))


def judge_mutations(
    requests: DataFrame,
    gold: DataFrame,
    key: str = KEY,
    ranges: int | None = None,
) -> DataFrame:
    """Every request with its verdict: ``reason`` NULL when applied, with ``op``,
    ``current_balance`` and ``currency`` of the resulting change (NULL for deletes)."""
    action = F.col("action")  # exact match, as the request model requires
    has_balance = F.col("balance").isNotNull()
    reqs = requests.select(
        F.col("seq").cast("long").alias("seq"),
        action.alias("action"),
        F.col(key),
        F.col("balance").cast("double").alias("balance"),
        F.col("currency"),
        F.lit(False).alias(VIRTUAL),
    )
    valid_insert = (F.col("action") == INSERT) & has_balance
    req_rows = reqs.select(
        "*",
        F.when(valid_insert, F.lit(True)).when(F.col("action") == DELETE, F.lit(False)).alias("_flag"),
        F.when(valid_insert, _currency_or_default(F.col("currency"))).alias("_icur"),
    )
    seed = _requested_state(requests, gold, key, ["currency"]).select(
        F.lit(-1).cast("long").alias("seq"),
        F.lit(None).cast("string").alias("action"),
        F.col(key),
        F.lit(None).cast("double").alias("balance"),
        F.lit(None).cast("string").alias("currency"),
        F.lit(True).alias(VIRTUAL),
        F.lit(True).alias("_flag"),
        F.col("currency").alias("_icur"),
    )
    positioned = F.col("seq").isNotNull() & (F.col("seq") >= 0)
    scanned = prefix_scan(
        req_rows.where(positioned).unionByName(seed),
        key,
        "seq",
        last_before={"_exists": "_flag", "_cur": "_icur"},
        ranges=ranges,
    )
    unplaced = req_rows.where(~positioned | F.col("seq").isNull()).select(
        "*", F.lit(None).cast("boolean").alias("_exists"), F.lit(None).cast("string").alias("_cur")
    )
    rows = drop_scan_partitioning(scanned).where(~F.col(VIRTUAL)).unionByName(unplaced)
    exists = F.coalesce(F.col("_exists"), F.lit(False))
    act = F.col("action")
    reason = (
        F.when(F.col("seq").isNull() | (F.col("seq") < 0), REASON_SEQ)
        .when(F.col(key).isNull(), REASON_KEY)
        .when(act.isNull() | ~act.isin(INSERT, UPDATE, DELETE), REASON_ACTION)
        .when(act.isin(INSERT, UPDATE) & ~has_balance, REASON_BALANCE)
        .when(act.isin(UPDATE, DELETE) & ~exists, REASON_NOT_FOUND)
    )
    op = (
        F.when(act == INSERT, F.when(exists, "u").otherwise("c"))
        .when(act == UPDATE, "u")
        .when(act == DELETE, "d")
    )
    currency = F.when(act == INSERT, _currency_or_default(F.col("currency"))).when(act == UPDATE, F.col("_cur"))
    return rows.select(
        "seq",
        key,
        "action",
        reason.alias("reason"),
        F.when(reason.isNull(), op).alias("op"),
        F.when(reason.isNull() & (act != DELETE), F.col("balance")).alias("current_balance"),
        F.when(reason.isNull(), currency).alias("currency"),
    )


def apply_mutations(requests: DataFrame, gold: DataFrame, key: str = KEY, **scan) -> DataFrame:
    """Accepted requests as change events (seq, key, op, current_balance, currency)."""
    judged = judge_mutations(requests, gold, key, **scan)
    return judged.where(F.col("reason").isNull()).select("seq", key, "op", "current_balance", "currency")


def rejected_mutations(requests: DataFrame, gold: DataFrame, key: str = KEY, **scan) -> DataFrame:
    judged = judge_mutations(requests, gold, key, **scan)
    return judged.where(F.col("reason").isNotNull()).select("seq", key, "action", "reason")


def delta_fold(
    requests: DataFrame,
    gold: DataFrame,
    key: str = KEY,
    ranges: int | None = None,
) -> DataFrame:
    """Relative updates folded into balances (M2).

    ``requests``: seq (>= 0), action, key, amount (base for insert, delta for update);
    requests without a valid position, a key or a needed amount are not applied (a state
    without a balance counts as 0).
    Returns the applied requests with the balance after each (NULL for deletes),
    computed exactly in DECIMAL and returned as double.

    One scan finds whether the account exists before each request, a second one over the same
    ranges the balance: that of the last applied insert (or the current one) and the deltas
    applied since.
    """
    act = F.col("action")
    reqs = requests.select(
        F.col("seq").cast("long").alias("seq"),
        act.alias("action"),
        F.col(key),
        F.col("amount").try_cast(EXACT).alias("amount"),
        F.lit(False).alias(VIRTUAL),
    )
    # an insert or update without an amount is rejected, as judge_mutations does
    reqs = reqs.where(~F.coalesce(F.col("action").isin(INSERT, UPDATE), F.lit(False)) | F.col("amount").isNotNull())
    req_rows = reqs.select(
        "*", F.when(F.col("action") == INSERT, F.lit(True)).when(F.col("action") == DELETE, F.lit(False)).alias("_flag")
    )
    seed = _requested_state(requests, gold, key, ["current_balance"]).select(
        F.lit(-1).cast("long").alias("seq"),
        F.lit(None).cast("string").alias("action"),
        F.col(key),
        F.coalesce(F.col("current_balance").try_cast(EXACT), F.lit(0).cast(EXACT)).alias("amount"),
        F.lit(True).alias(VIRTUAL),
        F.lit(True).alias("_flag"),
    )
    positioned = F.col("seq").isNotNull() & (F.col("seq") >= 0) & F.col(key).isNotNull()
    s1 = prefix_scan(
        req_rows.where(positioned).unionByName(seed),
        key,
        "seq",
        last_before={"_exists": "_flag"},
        ranges=ranges,
    )
    exists = F.coalesce(F.col("_exists"), F.lit(False))
    a, virtual = F.coalesce(F.col("action"), F.lit("")), F.col(VIRTUAL)
    s1 = s1.select(
        "*",
        (virtual | ((a == INSERT) & ~exists)).alias("_is_set"),
        ((a == UPDATE) & exists).alias("_is_add"),
        ((a == DELETE) & exists).alias("_is_del"),
    ).select(
        "*",
        F.when(F.col("_is_set"), F.col("amount")).alias("_set"),
        F.when(F.col("_is_add"), F.col("amount")).alias("_add"),
    )
    folded = set_or_add(s1, "seq", "_set", "_add", "_balance")
    rows = drop_scan_partitioning(folded).where(
        ~virtual & (F.col("_is_set") | F.col("_is_add") | F.col("_is_del"))
    )
    op = F.when(a == INSERT, "c").when(a == UPDATE, "u").otherwise("d")
    balance = F.when(~F.col("_is_del"), F.col("_balance").cast("double"))
    return rows.select("seq", key, op.alias("op"), balance.alias("current_balance"))


def mutation_changes(applied: DataFrame, base_lsn: int, at, base_offset: int | None = None, key: str = KEY) -> DataFrame:
    """Applied mutation events -> relational changes for the feed (commit order = ``seq``).

    ``lsn = base_lsn + seq`` keeps the batch after everything already committed when
    ``base_lsn`` exceeds the current maximum; ``at`` is the commit time (column or literal).
    """
    base_offset = base_lsn if base_offset is None else base_offset
    ts = at if isinstance(at, F.Column) else F.lit(at)
    return applied.select(
        F.col(key).cast("long").alias("account_id"),
        (F.lit(base_lsn) + F.col("seq")).cast("long").alias("lsn"),
        F.col("op"),
        ts.cast("timestamp").alias("ts"),
        F.col("current_balance").cast("double").alias("value"),
        (F.lit(base_offset) + F.col("seq")).cast("long").alias("off"),
        F.lit(False).alias("junk"),
        F.col("currency"),
    )


def insert_if_absent(requests: DataFrame, existing: DataFrame, key: str = KEY) -> DataFrame:
    """Rows an ``INSERT ... ON CONFLICT DO NOTHING`` batch adds (M3).

    The first insert per key wins (top-1 per key, partial before the shuffle), then
    keys already present are removed with an anti join. Requests without a key or a
    balance can't be rows of the table, so they are no inserts.
    """
    w = Window.partitionBy(key).orderBy(F.col("seq").asc())
    inserts = requests.where((F.col("action") == INSERT) & F.col(key).isNotNull() & F.col("balance").isNotNull())
    first = inserts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return first.join(existing.select(key), key, "left_anti")
