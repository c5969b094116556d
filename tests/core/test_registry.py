import glob
import os

import __spark_entry__ as entry
import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def same(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if v != v else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return [same(x) for x in v] if isinstance(v, (list, tuple)) else float(v) if isinstance(v, int) and not isinstance(v, bool) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.sql(entry.oracle_sql()[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    order = [want.columns.index(n) for n in names]
    a = sorted(str([same(r[n]) for n in names]) for r in got.collect())
    b = sorted(str([same(r[i]) for i in order]) for r in want.fetchall())
    assert a == b
