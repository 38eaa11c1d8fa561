"""Every registered query against its DuckDB oracle on the smallest fixture."""

import datetime as dt
import math

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as entry_mod

TABLES = ["events", "orders", "documents", "benchmark", "embeddings"]
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF001)
    rows = df.collect()
    cur = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    perm = [ocols.index(c) for c in df.columns]
    otypes = {d[0]: str(d[1]) for d in cur.description}
    assert {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields} == otypes
    a = sorted((tuple(_norm(x) for x in r) for r in rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in perm) for r in cur.fetchall()), key=_key)
    assert a == b


def test_every_query_has_oracle_or_is_listed():
    from roomstar.oracle import ORACLE
    from roomstar.queries import QUERIES
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["room", "coins", "gifts", "users", "coins_per_user"]
    assert df.count() == 15
