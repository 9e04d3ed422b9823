"""Every registered query against its SQL twin in DuckDB, on the smallest driver tables."""

import math
from pathlib import Path

import duckdb
import pytest

from marketlake.queries import REGISTRY, Tables

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


PAIRWISE_OR_PYTHON = ("CartesianProduct", "BroadcastNestedLoopJoin", "InPandas", "PythonUDF", "BatchEvalPython")


def _plain(values):
    return tuple(None if isinstance(v, float) and math.isnan(v) else v for v in values)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_matches_sql(name, spark, duck):
    query = REGISTRY[name]
    df = query.run(Tables(spark, FOLDER))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in PAIRWISE_OR_PYTHON if operator in plan]
    columns = sorted(df.columns)
    got = sorted((_plain(r) for r in df.select(*columns).collect()), key=repr)
    assert got, "a query over the driver tables returns rows"
    assert query.sql is not None
    relation = duck.sql(query.sql)
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[k] for c, k in df.dtypes} == kinds
    expected = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert got == sorted(map(_plain, expected), key=repr)
