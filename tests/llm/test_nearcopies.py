import numpy as np

import corpus_pipeline
from listweave.llm import nearcopies as N
from listweave.llm.blocks import described, packed, place
from listweave.llm.common import text_bytes


def words(text: str) -> set:
    found = text.lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))}


def test_prefix_of_similar_sets_meets_under_any_order():
    rng = np.random.default_rng(3)
    for n in (1, 4, 5, 9, 50, 333):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = a[rng.permutation(len(a))[: -(-4 * len(a) // 5)]]
        b.sort()
        level = dict(zip(a.tolist(), rng.integers(1, 5, len(a)).tolist(), strict=True))
        (x, at), (y, _) = (N.prefix(s, np.array([level[t] for t in s.tolist()])) for s in (a, b))
        assert set(x.tolist()) & set(y.tolist()) and at.tolist() == list(range(len(x))) and len(x) == N.prefix_size(len(a))


def test_prefix_leaves_out_what_no_other_document_has():
    tokens, level = np.arange(10, dtype=np.uint64), np.array([3, 0, 1, 1, 1, 1, 1, 1, 1, 1])
    got, at = N.prefix(tokens, level)
    assert N.prefix_size(10) == 3 and got.tolist() == [2, 3] and at.tolist() == [1, 2]


def test_sketches_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(5)
    for n in (0, 1, 30, 400, 5_000):
        a, b = (np.unique(rng.integers(0, 2 * n + 1, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        x, y = N.sketch(a), N.sketch(b)
        assert len(x) == N.SKETCH and N.sketch(a).tolist() == x.tolist()
        assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= len(np.setxor1d(a, b))


def test_pairs_of_the_similarity_pass_the_comparison_of_sketches(spark):
    """Right at the bound: 4 of 5 elements shared passes, sets that share far less do not."""
    rng = np.random.default_rng(6)
    rows = []
    for i, (same, own) in enumerate([(8, 1), (80, 10), (800, 100), (80, 60), (200, 150)]):
        all_ = np.unique(rng.integers(0, 1 << 62, same + 2 * own).astype(np.uint64))
        a, b = all_[: same + own], np.concatenate([all_[:same], all_[same + own :]])
        rows.append((i, *({"n": len(s), "at": 0, "bits": N.sketch(s).tolist()} for s in (a, b))))
    kind = "struct<n:int,at:int,bits:array<long>>"
    got = spark.createDataFrame(rows, f"i int, x {kind}, y {kind}").where(N._may_match("x", "y"))
    assert sorted(r.i for r in got.collect()) == [0, 1, 2]


def test_shared_prefixes_equal_a_count(spark):
    """Levels are exact: the elements that come back are those of the prefixes by the true counts."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in rng.integers(0, 2, int(rng.integers(0, 40)))) for _ in range(50)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    blocks = packed(docs, "t")
    sets = described(blocks, ["c0", "c1"], "node long, n int", lambda b: {"node": b.column(0), "n": [len(N.shingles(x)) for x in text_bytes(b, "c1")]})
    rows = sets.select(place().alias("p"), "node", "n").collect()
    own = {r.p: N.shingles(texts[r.node].encode()) for r in rows}
    count = {}
    for s in own.values():
        for t in s.tolist():
            count[t] = count.get(t, 0) + 1
    want = set()
    for p, s in own.items():
        order = sorted(s.tolist(), key=lambda t: (int(np.log2(count[t])), t))
        want |= {(p, t, i) for i, t in enumerate(order[: N.prefix_size(len(s))]) if count[t] > 1}
    nodes = spark.createDataFrame([(r.p, r.n) for r in rows], "node long, n int")
    got = {(r.node, r.token % (1 << 64), r["at"]) for r in N.shared_prefixes(blocks, nodes, 1).collect()}
    assert got == want and want


def test_stage_links_all_near_copies(spark):
    """Chains, copies whose fingerprints lie far apart, a common passage, and texts below the bound."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"common{i}" for i in range(30))
    texts = []
    for g in range(12):
        base = [f"g{g}w{int(w)}" for w in rng.integers(0, 10_000, 120)]
        for k in range(6):
            own = list(base)
            for at in rng.choice(120, k, replace=False):
                own[at] = f"new{g}x{k}x{at}"
            texts.append(" ".join(own) + (" " + passage if g % 2 else ""))
    ids = rng.permutation(len(texts)).tolist()
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = dict(zip(ids, map(words, texts), strict=True))
    for a in ids:
        for b in ids:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = sorted(i for i in ids if find(i) == i)
    assert 12 < len(want) < 60
    rows = [(i, t, "en", "src0", len(t)) for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == want


def test_one_of_a_repeated_id_and_all_without_one(spark, docs, no_docs):
    kept = N.keep_one_copy(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert [i for i, _ in got] == ["1", "3", "5", "7", "8", "None"]
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (None, "a b c d e f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in N.keep_one_copy(frame).collect()) == ["1", "None"]
    assert N.keep_one_copy(no_docs).count() == 0
