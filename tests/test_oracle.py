"""Every query with a SQL equivalent gives the same rows as DuckDB on the supplied tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _text(value):
    if isinstance(value, (decimal.Decimal, datetime.date, datetime.datetime)):
        return str(value)
    return repr(value)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    found = df.collect()
    cursor = duck.execute(ORACLE[name])
    described = {c[0]: str(c[1]) for c in cursor.description}
    wanted = cursor.fetchall()
    assert sorted(described) == sorted(df.columns)
    types = {c: SPARK_TYPES.get(t, t.lower()) for c, t in described.items()}
    assert types == dict(df.dtypes)
    columns = sorted(df.columns)
    place = [list(described).index(c) for c in columns]
    ours = sorted(tuple(_text(row[c]) for c in columns) for row in found)
    theirs = sorted(tuple(_text(row[i]) for i in place) for row in wanted)
    assert ours == theirs
