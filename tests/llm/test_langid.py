import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from listweave.llm import langid as L

VOWELS = {"xx": "aei", "yy": "ouy", "zz": "äöü"}


def sentence(lang: str, rng: random.Random, n: int = 30) -> str:
    return " ".join("".join(rng.choice("bdgk" if i % 2 else VOWELS[lang]) for i in range(rng.randint(2, 8))) for _ in range(n))


def brute_kneser_ney(texts: list[str], order: int, vocabulary: int):
    """Straightforward interpolated Kneser-Ney over strings."""
    counts = Counter()
    for t in texts:
        points, starts, _ = L.letters([t])
        chars = "".join(map(chr, points))
        padded = " " * (order - 1) + chars
        counts.update(padded[i : i + order] for i in range(len(chars)))
    levels = {order: dict(counts)}
    for n in range(order - 1, 0, -1):
        lower = defaultdict(int)
        for g in levels[n + 1]:
            lower[g[1:]] += 1
        levels[n] = dict(lower)

    discounts = {}
    for n, c in levels.items():
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discounts[n] = min(max(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.05), 0.95)

    def prob(gram: str) -> float:
        p = 1 / vocabulary
        for n in range(1, order + 1):
            own = gram[order - n :]
            ctx = {g: v for g, v in levels[n].items() if g[:-1] == own[:-1]}
            total = sum(ctx.values())
            if total:
                d = discounts[n]
                p = max(ctx.get(own, 0) - d, 0) / total + d * len(ctx) / total * p if own in ctx else d * len(ctx) / total * p
        return p

    return prob


def test_model_equals_brute_force():
    rng = random.Random(1)
    texts = [sentence("xx", rng, 12) for _ in range(5)]
    model = L.fit_model(texts, 100, 3)
    prob = brute_kneser_ney(texts, 3, 100)
    probe = sentence("xx", rng, 6) + " " + sentence("yy", rng, 3)
    points, starts, _ = L.letters([probe])
    grams = L.grams_of(points, starts, 3)
    got = model.log_prob(grams)
    for g, value in zip(grams, got):
        assert value == pytest.approx(math.log(prob("".join(map(chr, g)))))


def test_probabilities_sum_to_one():
    texts = ["abab abba baab", "aabb"]
    model = L.fit_model(texts, 50, 3)
    seen = sorted({c for t in texts for c in t})
    for context in ("ab", "  ", "zz", "b "):
        grams = np.array([[ord(c) for c in context] + [ord(c)] for c in seen], np.uint32)
        rest = np.array([[ord(c) for c in context] + [0x4E00]], np.uint32)
        total = np.exp(model.log_prob(grams)).sum() + (50 - len(seen)) * np.exp(model.log_prob(rest))[0]
        assert total == pytest.approx(1)


def test_letters_normalise():
    points, starts, n = L.letters(["Ab, C3d!", "", "123", "Éa"])
    text = "".join(map(chr, points))
    assert [text[a:b] for a, b in zip(starts, starts[1:])] == ["ab c d ", "", "", "éa"] and n.tolist() == [4, 0, 0, 2]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = [(i, sentence(lang, rng, 30), lang) for i, lang in ((i, sorted(VOWELS)[i % 3]) for i in range(240))]
    rows += [(1000, None, "xx"), (1001, "123 !!", "yy"), (1002, "abc", None), (None, sentence("xx", rng), "xx")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_accuracy_and_und(corpus):
    got = L.languages_of(corpus, L.fit_languages(corpus), keep=["doc_id", "lang"]).collect()
    clear = [r for r in got if r.doc_id is not None and r.doc_id < 1000]
    assert sum(r._lang == r.lang for r in clear) == len(clear) and not any(r._rejected for r in clear)
    odd = {r.doc_id: r for r in got if r.doc_id in (1000, 1001)}
    assert all(r._lang == "und" and r._score == 0 and r._rejected for r in odd.values())
    assert all(0 <= r._score <= 1 for r in got)


def test_strange_text_is_rejected(corpus, spark):
    found = L.fit_languages(corpus)
    strange = spark.createDataFrame([(1, "щжц фыв " * 40)], "doc_id long, text string")
    assert L.languages_of(strange, found).first()._rejected


def test_edge_cases(docs, no_docs):
    names = L.known_languages(docs).columns
    assert names == docs.columns
    found = L.fit_languages(docs)
    assert L.languages_of(docs, found, keep=docs.columns).count() == 10
    nothing = L.fit_languages(no_docs)
    assert nothing.names == [] and L.languages_of(no_docs, nothing).count() == 0
    assert {r._lang for r in L.languages_of(docs, nothing).collect()} == {"und"}


def test_fit_ignores_held_out_rows(corpus, spark):
    from listweave.llm.common import held_out

    changed = corpus.selectExpr("doc_id", "text", "lang").withColumn("text", __import__("pyspark.sql.functions", fromlist=["when"]).when(held_out("doc_id"), "qqq www").otherwise(corpus.text))
    a, b = L.fit_languages(corpus), L.fit_languages(changed)
    for x, y in zip(a.models, b.models):
        assert all((p == q).all() for o, r in zip(x.orders, y.orders) for p, q in zip(o, r))


def test_fit_is_bounded_under_repeats(spark):
    rng = random.Random(5)
    rows = [(i, sentence("xx", rng, 30) if "xx" in VOWELS else "aa bb cc dd " * 5, "xx") for i in range(20)]
    one = next(i for i in range(100, 200) if __import__("zlib").crc32(str(i).encode()) % 5)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hot = spark.range(50_000).selectExpr(f"{one}L AS doc_id", "'hot repeated words' AS text", "'xx' AS lang")
    a, b = L.fit_languages(frame.unionByName(hot.limit(1))), L.fit_languages(frame.unionByName(hot))
    assert all((x == y).all() for o, r in zip(a.models[0].orders, b.models[0].orders) for x, y in zip(o, r))


def test_languages_with_long_texts_only_are_learnt(spark):
    rows = [(i, ("abc " if i % 2 else "xyz ") * 400, "short" if i % 2 else "long") for i in range(40)]
    found = L.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), chars=100)
    assert found.names == ["long", "short"]


def test_models_are_refused_beyond_their_bound(corpus, monkeypatch):
    monkeypatch.setattr(L, "MODEL_BYTES", 10)
    with pytest.raises(ValueError, match="FIT_TOTAL"):
        L.fit_languages(corpus)


def test_names_of_results_and_helpers_may_clash(spark):
    frame = spark.createDataFrame([(1, "abc abc", "x", True, "q", 0.5)], "doc_id long, text string, lang string, _rejected boolean, c0 string, _score double")
    assert L.known_languages(frame).columns == frame.columns
    assert L.languages_of(frame, L.fit_languages(frame), keep=frame.columns).columns == ["doc_id", "text", "lang", "c0", "_lang", "_score", "_rejected"]
