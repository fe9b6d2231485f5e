"""Any keyed table: the account table is only the default spec."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType

from tidemark import schemas
from tidemark.operators import maintenance, state
from tidemark.operators.ingest import to_silver

ORDERS = schemas.TableSpec(
    key="order_id",
    key_type=LongType(),
    payload=(("status", StringType()), ("amount", DecimalType(12, 2)), ("customer_id", LongType())),
    event_time="updated",
    unused=(),
)


def env(op, order_id, lsn, status=None, amount=None):
    image = {"order_id": order_id, "status": status, "amount": amount, "customer_id": 7,
             "updated": "2024-05-01T10:00:00.000000Z"}
    doc = {"before": image if op == "d" else None, "after": None if op == "d" else image,
           "source": {"lsn": lsn}, "op": op}
    return json.dumps(doc)


def test_orders_table(spark):
    rows = [
        (env("c", 1, 1, "NEW", "10.50"), 1, 0, None),
        (env("u", 1, 3, "PAID", 10.5), 2, 0, None),
        (env("u", 1, 2, "LATE", 1), 9, 0, None),      # older commit, newer offset: loses
        (env("c", 2, 4, "NEW", 5), 3, 1, None),
        (env("d", 2, 5), 4, 1, None),
        ("{bad", 5, 1, None),
    ]
    silver = to_silver(spark.createDataFrame(rows, schemas.FEED), F.lit("2024-06-01 00:00:00"), spec=ORDERS)
    assert silver.columns == [f.name for f in ORDERS.silver().fields]
    gold = state.current_state(silver, key="order_id")
    assert gold.columns == ORDERS.gold_columns()
    got = {r["order_id"]: (r["status"], str(r["amount"]), r["operation_type"]) for r in gold.collect()}
    assert got == {1: ("PAID", "10.50", "UPDATE"), None: (None, "None", "UNKNOWN")}
    months = {r["event_month"] for r in silver.collect()}
    assert months == {"2024-05", "2024-06"}
    kept = maintenance.retained(silver, key="order_id").count()
    assert kept == 3  # order 1's winner, order 2's tombstone, the junk group


def test_change_table_with_another_spec(spark, workdir):
    import os

    from tidemark.table import ChangeTable

    t = ChangeTable(spark, os.path.join(workdir, "orders"), spec=ORDERS)
    rows = [(env("c", 1, 1, "NEW", 3), 1, 0, None), (env("u", 1, 2, "PAID", 3), 2, 0, None),
            (env("c", 2, 3, "NEW", 4), 3, 1, None)]
    t.backfill(spark.createDataFrame(rows, schemas.FEED))
    assert {r["order_id"]: r["status"] for r in t.gold().collect()} == {1: "PAID", 2: "NEW"}
    assert t.compact()["invalidated"] == 1
    t.register_views("orders_silver", "orders_gold")
    assert spark.table("orders_gold").columns == ORDERS.gold_columns()
