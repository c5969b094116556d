import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from listweave.llm import simhash as S
from listweave.llm.components import connected_components, forest


def brute_fingerprint(text: str) -> int:
    words = text.encode().translate(S.LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("text", ["", "one", "one two three", "A b C d e f g a b c d", "x " * 5000, "é ü ß a\tb\nc d\re\x0bf\x0cg"])
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def components_of(fps: dict[int, int], distance: int) -> dict[int, int]:
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if bin(fps[a] ^ fps[b]).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("bucket_rows", [4096, 8])
def test_links_equal_brute_force(spark, bucket_rows):
    rng = np.random.default_rng(5)
    fps: dict[int, int] = {}
    for c in range(40):
        center = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(2))
        for k in range(12):
            flips = rng.choice(64, int(rng.integers(0, 6)), replace=False)
            value = center
            for b in flips:
                value ^= 1 << int(b)
            fps[len(fps)] = value
    seen: dict[int, int] = {}
    for i, f in fps.items():
        seen.setdefault(f, i)
    distinct = {i: f for f, i in seen.items()}
    frame = spark.createDataFrame([(i, int(np.array(f, np.uint64).view(np.int64))) for i, f in distinct.items()], "rep long, fp long")
    got = {r.node: r.component for r in connected_components(S.link_forest(frame, 4, bucket_rows)).collect()}
    want = components_of(distinct, 4)
    assert {i: got.get(i, i) for i in want} == want


def test_plan_obeys_pigeonhole():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for rows in (100, 10**6, 10**9):
        parts = S.plan(sample, rows, 4)
        assert sorted(b for p in parts for b in p.bits) == list(range(64))
        assert sum(p.threshold + 1 for p in parts) == 5
    assert S.plan(sample, 10**9, 4) != S.plan(sample, 100, 4)


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    low = base & np.uint64(1)
    sample = base
    for b in (20, 40, 60):
        sample = (sample & ~np.uint64(1 << b)) | (low << np.uint64(b))
    groups = S.group_bits(sample, 4)
    assert any({0, 20, 40, 60} <= set(g) for g in groups)


def test_forest_spans_a_clique():
    n = 50
    a, b = np.triu_indices(n, 1)
    x, y = forest(a.astype(np.int64), b.astype(np.int64))
    assert len(x) == n - 1 and set(y) == {0}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and {got[i] for i in range(100, 140)} == {100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_edge_cases(docs, no_docs):
    got = S.near_duplicates(docs).collect()
    assert len(got) == 10
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.component_id)
    assert by[1] == [1] and by[2] == [1, 1] and by[None] == [None]
    assert by[3] == [3] and by[4] == [3] and by[6] == [3]  # no word: fingerprint zero, linked
    assert S.near_duplicates(no_docs).count() == 0


def test_keep_one(docs, no_docs):
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str)
    assert ids.count(1) == 1 and 2 not in ids and None in ids and 4 not in ids
    assert kept.where("doc_id = 1").select(F.length("text")).first()[0] == docs.where("doc_id = 1").select(F.length("text")).first()[0]
    assert S.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("task_edges", [0, 20, 10**6])
def test_components_in_rounds_and_in_one_task(spark, monkeypatch, task_edges):
    from listweave.llm import components

    monkeypatch.setattr(components, "TASK_EDGES", task_edges)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 105), (105, 101), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {100: 100, 101: 100, 105: 100, 200: 200, 201: 200}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
