import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog while seven wizards mix potions near the old stone bridge "


@pytest.fixture(scope="session")
def docs(spark):
    """Null and empty texts, nulls in every column, repeats, ties, a very long text, clashing names."""
    rows = [
        (1, LONG * 3, "en", "src0", 3),
        (2, LONG * 3, "en", "src0", 3),
        (2, LONG * 3, "en", "src0", 3),
        (3, None, "en", None, None),
        (4, "", None, "src1", 0),
        (None, LONG, "de", "src1", 1),
        (5, "Ünïcode ärger über Straßen\n\nund Häuser " + LONG, "de", "src9", 9),
        (6, " \t\n", "fr", "src2", 3),
        (7, "word " * 20_000 + LONG, "en", "src0", 9),
        (8, "ein kleiner Satz", "de", "src3", 2),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.selectExpr("*", "'x' AS score", "1 AS block", "2 AS row", "3 AS _epochs", "'y' AS c0", "'z' AS t")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
