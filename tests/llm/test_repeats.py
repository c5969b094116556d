import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from listweave.llm import repeats as R


def brute(rows: list[tuple[int | None, str | None]], length: int):
    """(removed mask) of each row, by looking every string up."""
    data = [(i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, int] = {}
    for i, b in data:
        if i is not None:
            for p in range(len(b) - length + 1):
                w = b[p : p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in data:
        mask = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - length + 1):
                if first[b[p : p + length]] < i:
                    mask[p : p + length] = b"\1" * length
        out.append(bytes(mask))
    return out


def check(spark, rows, length=50, gram=16):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = R.cut_repeats(frame, length=length, gram=gram).collect()
    want = sorted((str(i), len((t or "").encode()), m.count(1), len([x for x in m.split(b"\0") if x]), hashlib.sha256(bytes(c for c, z in zip((t or "").encode(), m) if not z)).hexdigest()) for (i, t), m in zip(rows, brute(rows, length)))
    assert sorted((str(r.doc_id), r._n_bytes, r._n_removed, len(r._spans), hashlib.sha256(bytes(r._kept)).hexdigest()) for r in got) == want


def test_random_repeats(spark):
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abcd é") for _ in range(rng.randint(20, 140))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(None, pieces[0] * 3), (5, pieces[1] * 2), (61, None), (62, ""), (63, "a" * 400), (64, "a" * 300), (65, "ab" * 200), (66, "x" * 49)]
    check(spark, rows)


def test_other_lengths(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab") for _ in range(80))) for i in range(20)]
    for length, gram in ((20, 8), (9, 4), (33, 16), (8, 3)):
        check(spark, rows, length, gram)


def test_empty_table_and_extra_columns(spark, docs, no_docs):
    assert R.cut_repeats(no_docs).count() == 0
    cut = R.cut_repeats(docs)
    assert set(docs.columns) - {"text"} <= set(cut.columns) and cut.count() == 10
    whole = R.without_repeats(docs)
    assert whole.columns == docs.columns and whole.schema["text"].dataType == docs.schema["text"].dataType
    by = {r.doc_id: r.text for r in whole.collect()}
    assert by[3] is None and by[1] != "" and by[2] == ""


def test_half_characters_go(spark):
    base = "0123456789" * 6
    rows = [(1, base + "é"), (2, base + "è tail")]  # both letters begin with the same byte
    got = {r.doc_id: r.text for r in R.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == base + "é" and got[2] == " tail"


@given(st.binary(min_size=0, max_size=400), st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_rolling_hash_is_local(data, k):
    t = np.frombuffer(data, np.uint8)
    if len(t) < k:
        return
    h = R.rolling_hash(t, k)
    assert len(h) == len(t) - k + 1
    for i in range(0, len(h), 7):
        assert h[i] == R.rolling_hash(t[i : i + k].copy(), k)[0]


@given(st.lists(st.binary(min_size=0, max_size=120), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_passages_hold_every_window_once(parts):
    t = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    first, count, _ = R.passages(t, sizes, 20, 6)
    windows = np.concatenate([np.arange(a, a + c) for a, c in zip(first, count)]) if len(first) else np.zeros(0, int)
    ends = sizes.cumsum()
    want = [p for e, n in zip(ends, sizes) for p in range(e - n, e - 20 + 1)]
    assert sorted(windows.tolist()) == want


@pytest.mark.parametrize("length", [5, 8, 9, 16, 20, 50, 64])
@pytest.mark.parametrize("letters", [1, 2, 4, 250])
@pytest.mark.parametrize("cut", [(8, 16), (3, 2), (2, 5), (4, 1)])
def test_corpus_order(length, letters, cut):
    """Windows come in the order of their text to its end, and runs are the equal ones."""
    rng = np.random.default_rng(length * 1000 + letters)
    base = [bytes(rng.integers(0, letters, int(rng.integers(1, 120))).astype(np.uint8)) for _ in range(6)]
    words = [b"".join(base[i] for i in rng.integers(0, 6, int(rng.integers(1, 5)))) for _ in range(25)]
    words = sorted({w for w in words if len(w) >= length}) or [bytes(length)]
    order, run, text = R.runs(words, length, *cut)
    places = [(w, p) for w in range(len(words)) for p in range(len(words[w]) - length + 1)]
    assert [w for w, _ in places] == text.tolist() and sorted(order.tolist()) == list(range(len(places)))
    seen = [words[places[i][0]][places[i][1] :] for i in order]
    heads = [s[:length] for s in seen]
    assert heads == sorted(heads)
    want = np.cumsum([0] + [int(a != b) for a, b in zip(heads, heads[1:])])
    assert run.tolist() == want.tolist()


@given(st.lists(st.binary(min_size=1, max_size=80), min_size=1, max_size=5), st.integers(1, 6), st.integers(1, 8))
@settings(max_examples=80, deadline=None)
def test_parse(parts, gram, every):
    """Phrases overlap by a gram and give the text back; inside a phrase there is no trigger."""
    t, sizes = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    begin, end, of = R.parse(t, sizes, gram, every)
    whole = b"".join(parts)
    for w, p in enumerate(parts):
        own = [whole[a:b] for a, b in zip(begin[of == w], end[of == w])]
        assert own[0] + b"".join(x[gram:] for x in own[1:]) == p
    bodies = {whole[a:b] for a, b, last in zip(begin, end, np.append(of[1:] != of[:-1], True)) if not last}
    assert not any(x != y and y.startswith(x) for x in bodies for y in bodies if len(x) > gram)


def test_parse_ranks():
    rng = np.random.default_rng(5)
    phrase, of = rng.integers(0, 3, 200), np.sort(rng.integers(0, 9, 200))
    rank = R.parse_ranks(phrase, of, 200)
    keys = [phrase[i:][of[i:] == of[i]].tolist() for i in range(200)]
    order = {tuple(k): i for i, k in enumerate(sorted(set(map(tuple, keys))))}
    assert rank.tolist() == [order[tuple(k)] for k in keys]


def test_a_frequent_anchor_is_split(spark, monkeypatch):
    """One gram in all documents, with ever new surroundings, and some repeats among them."""
    monkeypatch.setattr(R, "FREQUENT", 5)
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = noise(40) + "0123456789abcdef" + noise(40)
    rows = [(i, noise(60) + "0123456789abcdef" + noise(60) + (shared if i % 7 == 0 else "")) for i in range(120)]
    check(spark, rows)


def test_clashing_names(spark):
    rows = [(1, "ab" * 60, 5, "k", "s", 1), (2, "x" + "ab" * 60, 5, "k", "s", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _was_null int, _kept string, _spans string, c0 int")
    whole = R.without_repeats(frame)
    assert whole.columns == frame.columns
    assert [tuple(r)[2:] for r in sorted(whole.collect())] == [(5, "k", "s", 1), (5, "k", "s", 2)]
    cut = {r.doc_id: r for r in R.cut_repeats(frame).collect()}
    assert cut[2]._n_removed == 120 and bytes(cut[2]._kept) == b"x" and cut[1]._was_null == 5
