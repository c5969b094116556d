import base64
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from listweave.llm import bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
CODEC = B.Codec(RANKS, P.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@given(st.text(max_size=200), st.integers(4, 40), st.integers(0, 40))
@settings(max_examples=300, deadline=None)
def test_chunks_never_matter(text, chunk, overlap):
    ids = CODEC.encode(text, chunk, overlap)
    assert ids == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("alphabet", ["ab 'll\n", "a' \t\n1'r", "é ß!'s  ", "    a", "abcdefg", "  "])
def test_boundaries_at_chunk_ends(alphabet):
    rng = random.Random(alphabet)
    for _ in range(200):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))
        assert CODEC.encode(text, rng.randint(20, 60), rng.randint(0, 40)) == REFERENCE.encode_ordinary(text)


def test_long_pieces_and_special_strings():
    for text in ("a" * 3000, "<|endoftext|> x", "9" * 500, "\n" * 700 + "x", "é" * 900):
        assert CODEC.encode(text, 256, 32) == REFERENCE.encode_ordinary(text)


def test_documents(docs, no_docs):
    got = B.encode_documents(docs, PATH, P.PATTERN, keep=["doc_id", "score", "c0"], chunk=1000, overlap=64, with_ids=True).collect()
    want = {r.doc_id: REFERENCE.encode_ordinary(r.text or "") for r in docs.collect()}
    assert len(got) == 10
    for r in got:
        assert r.ids == want[r.doc_id] and r.n_tokens == len(r.ids) and r.score == "x" and r.c0 == "y"
    assert B.encode_documents(no_docs, PATH, P.PATTERN).count() == 0


def test_pattern_only_looks_ahead():
    """The stitch rests on this: no look-behind and no anchor in the pattern."""
    assert "(?<" not in P.PATTERN and "^" not in regex.sub(r"\[\^", "", P.PATTERN)
