"""Queries see whole texts and all rows of the tables they stand on."""

from listweave.plans.adapters import base, view
from listweave.plans.registry import queries
from listweave.plans.state_queries import _pages

DOCS = "doc_id long, text string, lang string, source string"


def test_listings_are_searched_in_their_whole_text(spark, tmp_path):
    rows = [(0, "filler " * 20 + "therefore", "en", "src0"), (1, "filler " * 20, "en", "src0")]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert [r.id for r in queries()["search_ranked"](spark, str(tmp_path)).collect()] == [0]


def test_views_keep_all_rows(spark):
    sf = "/root/testdata/sf0.001"
    for name, table in (("results", "lineitem"), ("fetch_attempts", "lineitem"), ("raw_objects", "orders")):
        assert view(spark, sf, name).count() == base(spark, sf, table).count()
    lines = base(spark, sf, "lineitem").where("l_partkey % 4 > 0")
    pages = lines.selectExpr("l_orderkey % 500", "l_orderkey % 2", "l_orderkey div 1000", "l_partkey % 12").distinct().count()
    assert _pages(spark, sf).selectExpr("sum(size(urls)) AS n").first().n == pages
