"""Queries over texts equal their SQL on texts that the tables of the driver hardly hold."""

import __spark_entry__ as entry
import duckdb
import pytest
from tests.core.test_registry import same

DOCS = "doc_id long, text string, lang string, source string"
TEXTS = [
    None, "", "c### c# .net node.js C++ c++ c++", "Æsir œuvre ǣ Straße ẞ", "ΟΔΟΣ Σ ΣΑΣ.", "é x࢘y \U00011f00z", "İI ıi Đà Nẵng ŁØ",
]


def answers(spark, path, name, rows):
    """Sorted rows of the query and of its SQL over these documents."""
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{path}/documents.parquet")
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    want = c.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, str(path)).select(*want.columns).collect()
    return [sorted(str([same(v) for v in r]) for r in x) for x in (got, want.fetchall())]


@pytest.mark.parametrize("text", TEXTS)
def test_search_form_equals_sql(spark, tmp_path, text):
    got, want = answers(spark, tmp_path, "text_search_form", [(1, text, "en", "s")])
    assert got == want


SEARCHED = [
    "the " + "oats " * 16400 + "the rye", "oats " * 16400 + "the python", "the", "python the pythonic", "t\u0301he the python", "c#-the node.js the", "c++ c++-c++-the C++", "the-python THE PYTHÓN Straße the", "thæ the", None, "",
]

#: Bits of the places that hold "the", the last place lowest.
NEAR = (11850, 14968)


@pytest.mark.parametrize("text", SEARCHED)
def test_search_of_all_terms_equals_sql(spark, tmp_path, text):
    got, want = answers(spark, tmp_path, "search_all_terms", [(i, text, "en", "s") for i in range(4)])
    assert got == want


def test_scores_are_rounded_once(spark, tmp_path):
    # in these the score lies so near the middle of two that a float of it is on the other side
    rows = [(4 * i, " ".join("the" if m >> d & 1 else "rye" for d in reversed(range(15))), "en", "s") for i, m in enumerate(NEAR)]
    got, want = answers(spark, tmp_path, "search_all_terms", rows)
    assert got == want
