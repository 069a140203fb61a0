"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from cellpulse.queries.catalog import CATALOG
from cellpulse.queries.oracle import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean", "DATE": "date",
}
# Python rows and cross joins must not appear in any plan.
FORBIDDEN = ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, folder, duck, name):
    df = CATALOG[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in FORBIDDEN:
        assert word not in plan
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert dict(df.dtypes) == {c[0]: TYPES[str(c[1])] for c in result.description}
    order = [columns.index(c) for c in df.columns]
    expected = Counter(repr(tuple(row[i] for i in order)) for row in result.fetchall())
    assert Counter(repr(tuple(row)) for row in df.collect()) == expected


MODEL_QUERIES = sorted(set(CATALOG) - set(QUERIES) - {"stack_models", "ranked_models", "tune_gbt"})


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_gives_rows(spark, folder, name):
    assert CATALOG[name](spark, folder).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert {"cell_id", "time_window", "incident_count"} <= set(df.columns)
    assert df.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
