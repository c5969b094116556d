import glob
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from listweave.llm import queries as Q
from listweave.llm import topk as K


def brute(rows, k):
    """Every row is a candidate, and a query of its own if its id is divisible by 20."""
    w = [(i, [math.floor(64 * c) for c in x]) for i, x in rows if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for p, (q, x) in enumerate(w):
        if q % 20 == 0:
            scored = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(x, y)))), c) for o, (c, y) in enumerate(w) if o != p)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    return sorted(out)


def run(frame, k=20):
    return sorted(tuple(r) for r in K.top_k(K.vector_rows(frame, F.col("vec_id") % 20 == 0), k).collect())


def table():
    rng = random.Random(9)
    rows = [(i, [rng.choice([0.0, 0.0, -0.5, 0.25, 1.0, 0.01, 3.5]) for _ in range(6)]) for i in range(90)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf")] * 6), (None, [1.0] * 6), (120, [1.0, 1.0]), (121, []), (140, [0.0] * 6)]
    rows += [(5, rows[5][1]), (5, [9.0] * 6), (20, [8.0] * 6), (20, rows[20][1]), (1, [128.0] * 6), (1, [2.0] * 6)]  # repeats, equal and not
    return [(i, None if x is None else [None if c is None else float(np.float32(c)) for c in x]) for i, x in rows]


@pytest.mark.parametrize("sizes", [(16_384, 2048), (7, 3), (1, 1)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(K, "CANDIDATES", sizes[0])
    monkeypatch.setattr(K, "QUERIES", sizes[1])
    rows = table()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    named = frame.selectExpr("*", "1 AS score", "2 AS block", "3 AS query", "4 AS x")
    assert run(named) == brute(rows, 20)


def test_sql_keeps_repeated_ids_too(spark, tmp_path):
    rows = [(i, x) for i, x in table() if x is None or len(x) == 6]  # SQL has products of equal lengths only
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    c = duckdb.connect()
    c.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{glob.glob(str(tmp_path / 'embeddings.parquet'))[0]}/*.parquet'")
    want = sorted(c.sql(Q.oracle_sql()["op5_exact_top_k"]).fetchall())
    got = sorted(tuple(r) for r in Q.op5_exact_top_k(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect())
    assert got == want == brute(rows, 20)


def test_wide_numbers(spark):
    rows = [(0, [1e300, -1e300]), (1, [1e300, 1.0]), (2, [-1e300, 5.0]), (3, [1.0, 1.0]), (20, [2.0**55, 2.0**40])]
    exact = [(i, [max(-(1 << 63), min((1 << 63) - 1, math.floor(64 * c))) / 64 for c in x]) for i, x in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    w = {i: [max(-(1 << 63), min((1 << 63) - 1, math.floor(64 * c))) for c in x] for i, x in rows}
    want = []
    for q in (0, 20):
        scored = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(w[q], w[c])))), c) for c in w if c != q)
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    assert run(frame) == sorted(want) and len(exact) == 5


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert run(none) == []
    assert run(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")) == []
    assert run(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")) == []


def test_block_top_ties_and_wide_scores():
    c = np.array([[10**6], [10**6], [-5], [0]], np.int64)
    q, v, s = K.block_top([np.array([10**6], np.int64)], np.array([4, 2, 3, 9]), c, 2)
    assert v.tolist() == [2, 4] and s.tolist() == [10**12, 10**12]
    q, v, s = K.block_top([np.array([10**6], np.int64)], np.array([4, 2, 3, 9]), c, 2, np.array([1]))
    assert v.tolist() == [4, 9]
