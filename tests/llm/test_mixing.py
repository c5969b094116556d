from fractions import Fraction
import hashlib
import random

import pytest

from listweave.llm import mixing as M

ROWS = "doc_id long, text string, lang string, source string"


def brute(rows, mix: M.Mix):
    """Epochs of each (domain, lang, source, id) by exact water-filling with fractions."""
    leaf: dict = {}
    for path, key, n in rows:
        leaf.setdefault(path, {}).setdefault(key, 0)
        leaf[path][key] += n
    tokens = {p: sum(d.values()) for p, d in leaf.items()}

    def cap(prefix):
        return sum(t for p, t in tokens.items() if p[: len(prefix)] == prefix) * mix.epochs

    def weight(depth, value):
        return mix.weights.get(mix.levels[depth], {}).get(value, mix.default)

    budget = {(): sum(tokens.values()) * mix.share[0] // mix.share[1]}
    for depth in range(len(mix.levels)):
        new = {}
        for prefix, got in budget.items():
            kids = sorted({p[: depth + 1] for p in tokens if p[:depth] == prefix}, key=lambda k: (Fraction(cap(k), weight(depth, k[-1])), k[-1]))
            left, w = got, sum(weight(depth, k[-1]) for k in kids)
            full = []
            for k in kids:
                wk = weight(depth, k[-1])
                if cap(k) * w <= left * wk:
                    new[k] = cap(k)
                    full.append(k)
                    left -= cap(k)
                    w -= wk
                else:
                    break
            for k in kids:
                if k not in full:
                    new[k] = min(cap(k), left * weight(depth, k[-1]) // w)
        budget = new
    out = {}
    for p, docs in leaf.items():
        whole, rest = divmod(budget[p], tokens[p]) if tokens[p] else (0, 0)
        upto = 0
        for key in sorted(docs, key=lambda k: (hashlib.md5(f"{mix.seed}:{whole}:{k}".encode()).hexdigest(), k)):
            upto += docs[key]
            out[(p, key)] = whole + (upto <= rest)
    return budget, tokens, out


@pytest.mark.parametrize("epochs,share", [(1, (1, 2)), (4, (1, 1)), (2, (3, 1)), (1, (1, 1))])
def test_equals_brute_force(spark, epochs, share):
    rng = random.Random(epochs)
    rows = []
    for i in range(400):
        path = (rng.choice("ab"), rng.choice(["en", "de", "fr"]), "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 4)}")
        rows.append((path, str(i % 390), rng.randint(0, 50)))
    mix = M.Mix(levels=("d", "l", "s"), weights={"d": {"a": 3, "b": 1}, "l": {"en": 5}, "s": {"hot": 2}}, share=share, epochs=epochs)
    frame = spark.createDataFrame([(*p, k, n) for p, k, n in rows], "d string, l string, s string, k string, n long")
    got = M.mixture(frame, mix, "k", "n").collect()
    budget, tokens, want = brute(rows, mix)
    assert len(got) == len(rows)
    assert all(r._epochs == want[((r.d, r.l, r.s), r.k)] for r in got)
    totals = frame.groupBy("d", "l", "s").sum("n").withColumnRenamed("sum(n)", "tokens")
    assert {(r.d, r.l, r.s): int(r.budget) for r in M.leaf_budgets(totals, mix).collect()} == budget
    assert all(b <= tokens[p] * epochs for p, b in budget.items())


def test_siblings_take_a_shortage_first(spark):
    totals = spark.createDataFrame([("a", "x", "1", 10), ("a", "y", "1", 1000), ("b", "x", "1", 1000)], "d string, l string, s string, tokens long")
    got = {(r.d, r.l): int(r.budget) for r in M.leaf_budgets(totals, M.Mix(levels=("d", "l", "s"), share=(800, 2010))).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 390, ("b", "x"): 400}


def test_slices_do_not_matter(spark):
    frame = spark.createDataFrame([("d", "l", "s", str(i), i % 9 + 1) for i in range(300)], "d string, l string, s string, k string, n long")
    results = [sorted((r.k, r._epochs) for r in M.mixture(frame, M.Mix(levels=("d", "l", "s"), share=(1, 3), slice_digits=n), "k", "n").collect()) for n in ((1,), (1, 2), (2, 3, 5))]
    assert results[0] == results[1] == results[2]


def test_documents(docs, no_docs):
    got = M.mix_corpus(docs).collect()
    assert len(got) == 10 and all(r.epochs >= 0 for r in got)
    mixed = M.mixed_documents(docs, M.Mix(share=(2, 1), epochs=2))
    assert mixed.columns == docs.columns and mixed.where("doc_id = 8").count() == 2
    assert M.mix_corpus(no_docs).count() == 0 and M.mixed_documents(no_docs, M.CORPUS_MIX).count() == 0
