"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from millrace.plans.queries import ORACLE_SQL, QUERIES

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLE_SQL:
        assert got
        return
    cursor = duck.execute(ORACLE_SQL[name])
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    order = [list(kinds).index(c) for c in columns]
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema} == kinds
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
