"""Queries that choose a latest row, at a size where orders and lines repeat with different content."""

import glob
import os

import __spark_entry__ as entry
import duckdb
import pytest

from listweave.operators import tables
from listweave.plans.adapters import view
from tests.core.test_registry import same

SF = "/root/testdata/sf0.01"
NAMES = [
    "table_latest", "health_current_parse_status", "health_summary", "health_issue_samples", "health_parse_outcomes_in_window", "health_policy_alerts", "health_raw_and_backlog",
    "state_current_results", "state_retention_candidates", "enrich_candidates", "enrich_rolling_usage", "publish_uncommitted_active", "stats_facets", "stats_rollup",
]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF), duck.sql(entry.oracle_sql()[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    order = [want.columns.index(n) for n in names]
    assert sorted(str([same(r[n]) for n in names]) for r in got.collect()) == sorted(str([same(r[i]) for i in order]) for r in want.fetchall())


@pytest.mark.parametrize("name", ["results", "parse_attempts", "fetch_attempts"])
def test_ids_are_unique(spark, name):
    rows = view(spark, SF, name)
    assert rows.count() == rows.select("id").distinct().count()


def test_latest_is_definite_where_the_order_ties(spark):
    rows = spark.createDataFrame([(1, 5, "b", None), (1, 5, "a", [2]), (1, 4, "0", None), (2, None, "z", [])], "k int, at int, v string, x array<int>")
    for parts in (1, 3, 7):
        got = tables.latest(rows.repartition(parts), ["k"], [rows.at.desc()]).collect()
        assert sorted((r.k, r.v) for r in got) == [(1, "a"), (2, "z")]
