import numpy as np
import pytest

from listweave.llm import gbt, ridge
from listweave.llm.common import held_out
from listweave.llm.stats import FEATURES, SYMBOLS, document_stats


def brute_base(text: str):
    words = text.encode().split()
    n = len(words)
    dup = set()
    grams: dict = {}
    for i in range(n - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    for at in grams.values():
        if len(at) > 1:
            dup |= {i + k for i in at for k in range(5)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            lines += line in seen
            seen.add(line)
    return n, sum(len(w.decode()) for w in words), sum(text.count(chr(c)) for c in SYMBOLS), lines, len(dup)


TEXTS = [
    "", " \n\t ", "one", "a b c d e a b c d e", "x " * 50, "é ü ß\nline\nline\n\n \nline", "#*$%&|<> " * 4, "w1 w2 w3 w4 w5 w6 w1 w2 w3 w4 w5 z w2 w3 w4 w5 w6",
    " no break space x", " ".join(str(i % 7000) for i in range(20_000)), "a\x1cb c",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_statistics(text):
    assert document_stats(text.encode())[0] == brute_base(text)
    assert len(document_stats(text.encode())[1]) == len(FEATURES)


def test_repeated_words_beyond_packing():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in rng.integers(0, 30_000, 40_000)] + [f"q{i}" for i in range(9)] * 2
    text = " ".join(words)
    assert document_stats(text.encode())[0] == brute_base(text)


def data(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.uniform(0, 1, (n, 4))
    y = ((x[:, 0] + 0.1 * rng.normal(size=n) < 0.6) & (x[:, 1] < 0.9)).astype(float)
    return x, y


def test_trees_learn_and_obey_constraints():
    x, y = data()
    trees = gbt.fit_trees(x, y, np.array([-1, 0, 0, 1]), rounds=40)
    test_x, test_y = data(seed=2)
    assert ((trees.score(test_x) > 0.5) == test_y).mean() > 0.8
    grid = np.linspace(-0.5, 1.5, 60)
    for j, sign in ((0, -1), (3, 1)):
        for row in test_x[:40]:
            rows = np.repeat(row[None], len(grid), 0)
            rows[:, j] = grid
            assert (sign * np.diff(trees.score(rows)) >= -1e-12).all()


def test_flat_trees_equal_a_walk():
    x, y = data()
    t = gbt.fit_trees(x, y, np.zeros(4), rounds=10)
    for row, score in zip(x[:50], t.score(x[:50])):
        total = t.base
        for root in t.roots:
            at = root
            while t.left[at] != at:
                at = t.left[at] if row[t.feature[at]] <= t.cut[at] else t.right[at]
            total += t.value[at]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_constant_labels_and_no_rows():
    assert gbt.fit_trees(np.zeros((0, 3)), np.zeros(0), np.zeros(3)).score(np.ones((2, 3))).tolist() == [0.5, 0.5]
    assert gbt.fit_trees(np.ones((9, 3)), np.ones(9), np.zeros(3)).score(np.ones((1, 3)))[0] > 0.9


def test_isotonic_pools_violators():
    knots, levels = ridge.isotonic(np.array([1.0, 2, 3, 4, 5, 6]), np.array([0, 1, 0, 1, 1, 1]))
    assert (np.diff(knots) >= 0).all() and (np.diff(levels) >= 0).all() and 0 < levels[0] < levels[-1] < 1
    assert len(ridge.isotonic(np.zeros(0), np.zeros(0))[0]) == 1


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 5))
    omega, phase = rng.normal(size=(5, 6000)), rng.uniform(0, 2 * np.pi, 6000)
    z = ridge.fourier(x, np.zeros(5), np.ones(5), omega, phase)[:, 1:]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / 2)
    assert np.abs(z @ z.T - exact).max() < 0.08


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    good = lambda: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(40)) + "."
    bad = lambda: " ".join("###" if rng.random() < 0.5 else "BUY" for _ in range(40))
    rows = [(i, good() if i % 2 else bad()) for i in range(400)]
    labels = [(i, i % 2, 0) for i in range(300)] + [(0, 0, 1), (7, 0, 0), (None, 1, 0), (9, None, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rules_on_held_out_rows(corpus):
    docs, labels = corpus
    got = gbt.quality_rules(docs, gbt.fit_quality(docs, labels)).where(held_out("doc_id")).toPandas()
    good = got.doc_id % 2 == 1
    assert got.kept[good & ~got.base_failed].mean() > 0.98 and not got.kept[~good].any()
    assert not got.kept[got.base_failed].any()


def test_classifier_on_held_out_rows(corpus):
    docs, labels = corpus
    got = ridge.quality_scores(docs, ridge.fit_ridge(docs, labels)).where(held_out("doc_id")).toPandas()
    assert (got.predicted == got.doc_id % 2).mean() > 0.97 and got.score.between(0, 1).all()


def test_edge_cases(corpus, docs, no_docs, spark):
    _, labels = corpus
    trees, model = gbt.fit_quality(docs, labels), ridge.fit_ridge(docs, labels)
    rules, scores = gbt.quality_rules(docs, trees), ridge.quality_scores(docs, model)
    assert rules.count() == 10 and scores.count() == 10
    empty = [r for r in rules.collect() if r.doc_id in (3, 4, 6)]
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in empty)
    none = spark.createDataFrame([], labels.schema)
    assert gbt.quality_rules(no_docs, gbt.fit_quality(no_docs, none)).count() == 0
    assert ridge.quality_scores(no_docs, ridge.fit_ridge(no_docs, none)).count() == 0
    assert all(0 <= r.score <= 1 for r in ridge.quality_scores(docs, ridge.fit_ridge(docs, none)).collect())


def test_held_out_matches_crc32(spark):
    import zlib

    rows = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_first_tree_makes_the_best_split():
    """One round of depth one against every cut of every feature, by the same gain worked out directly."""
    x, y = data()
    x = np.round(x, 1)
    t = gbt.fit_trees(x, y, np.zeros(x.shape[1]), rounds=1, depth=1, bins=10_000, min_rows=1)
    p = 1 / (1 + np.exp(-t.base))
    g, h = y - p, np.full(len(y), p * (1 - p))
    gain = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1)
    best = max((gain(x[:, j] <= c) + gain(x[:, j] > c), -j, -c) for j in range(x.shape[1]) for c in np.unique(x[:, j])[:-1])
    root = t.roots[0]
    j, cut = t.feature[root], t.cut[root]
    assert gain(x[:, j] <= cut) + gain(x[:, j] > cut) == pytest.approx(best[0], rel=1e-6)
    for side, node in ((x[:, j] <= cut, t.left[root]), (x[:, j] > cut, t.right[root])):
        assert t.value[node] == pytest.approx(0.2 * g[side].sum() / (h[side].sum() + 1))


def test_ridge_equals_least_squares():
    """The normal equations against a direct least-squares solution of the augmented system."""
    rng = np.random.default_rng(5)
    z, y = rng.normal(size=(200, 30)), rng.integers(0, 2, 200).astype(float)
    direct = np.linalg.lstsq(np.vstack([z, np.sqrt(ridge.PENALTY * 200) * np.eye(30)]), np.concatenate([y, np.zeros(30)]), rcond=None)[0]
    assert np.allclose(ridge.solved(z.T @ z, z.T @ y, 200), direct)


def test_isotonic_equals_the_min_max_formula():
    """Before smoothing, the level of a row is the largest of the smallest means of ranges around it."""
    rng = np.random.default_rng(6)
    for _ in range(20):
        n = int(rng.integers(1, 30))
        raw, y = np.sort(rng.normal(size=n)), rng.integers(0, 2, n)
        want = [max(min(y[a : b + 1].mean() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        knots, levels = ridge.isotonic(raw, y)
        edges = np.flatnonzero(np.diff(want, prepend=-1.0) > 1e-12)
        sizes = np.diff(np.append(edges, n))
        assert len(knots) == len(edges)
        smooth = [(y[a : a + s].sum() + 0.5) / (s + 1) for a, s in zip(edges, sizes)]
        assert np.allclose(levels, np.maximum.accumulate(smooth)) and np.allclose(knots, [raw[a : a + s].mean() for a, s in zip(edges, sizes)])


def test_fits_repeat_and_are_bounded_under_repeated_rows(corpus, spark):
    docs, labels = corpus
    one = next(i for i in range(300) if __import__("zlib").crc32(str(i).encode()) % 5 and i not in (0, 7, 9))
    text = docs.where(f"doc_id = {one}").first().text
    hot = spark.range(50_000).selectExpr(f"{one}L AS doc_id").withColumn("text", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(text))
    a, b = ridge.fit_ridge(docs, labels), ridge.fit_ridge(docs.unionByName(hot).repartition(7), labels)
    assert (a.weight == b.weight).all() and (a.levels == b.levels).all()
    s, t = gbt.fit_quality(docs, labels), gbt.fit_quality(docs.unionByName(hot), labels)
    assert (s.value == t.value).all() and (s.cut == t.cut).all()
