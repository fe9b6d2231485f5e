"""Every registered query against its DuckDB oracle (the driver's gate, locally)."""

import pytest

import __spark_entry__ as E
from compare import compare_one, duck

from conftest import SF_SMALL

from tidemark.plans.catalog import QUERIES as CATALOG

QUERIES = {name: fn for name, fn in E.queries().items() if name in CATALOG}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in CATALOG}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, detail = compare_one(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, detail
    assert n > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 148
    assert df.columns == ["account_id", "current_balance", "currency", "transaction_timestamp",
                          "source_commit_lsn", "operation_type"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "decimal(14,2)": "DECIMAL(14,2)", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_vs_batch", "visible_after_compaction",
                                                      "compaction_history", "gold_incremental", "sized_sink",
                                                      "restart_delivery", "visible_arranged_replay"}))
def test_column_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {r[0]: r[1] for r in con.execute("DESCRIBE " + ORACLE[name]).fetchall()}
    assert ours == theirs
