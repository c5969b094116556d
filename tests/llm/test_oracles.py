import glob
import os

import duckdb
import pytest

from listweave.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got, want = Q.queries()[name](spark, SF), c.sql(Q.oracle_sql()[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    order = [want.columns.index(n) for n in names]
    assert sorted(str([r[n] for n in names]) for r in got.collect()) == sorted(str([r[i] for i in order]) for r in want.fetchall())
