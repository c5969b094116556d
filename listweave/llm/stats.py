"""Statistics of a document's text, for the quality rules and the quality classifier."""

from __future__ import annotations

import re

import numpy as np

SYMBOLS = b"#*$%&|<>"
_UPPER, _LOWER, _DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789"
_STOPS, _CONTINUED = b".!?", bytes(range(128, 192))
_SPACE = b" \t\n\x0b\x0c\r"
_RUNS = re.compile(rb"!!|\?\?|\.\.\.")

#: Base statistics of a text, in this order.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the models see, in this order; all are ratios or logarithms, none names the language.
FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "top_word_share",
    "same_word_share",
    "upper_share",
    "digit_share",
    "shout_rate",
    "stop_rate",
    "line_words",
    "one_char_share",
)


def repeated_words(codes: np.ndarray, distinct: int, window: int = 5) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text.

    Codes are exact: windows are packed into integers, with re-ranking where they would overflow.
    """
    n = len(codes) - window + 1
    if n < 2 or distinct == len(codes):
        return 0
    key, span = codes[:n].astype(np.int64), int(distinct)
    for k in range(1, window):
        if span > (1 << 62) // max(distinct, 1):
            values, key = np.unique(key, return_inverse=True)
            span = len(values)
        key = key * distinct + codes[k : k + n]
        span *= distinct
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(codes) + 1, np.int64)
    at = order[twice]
    edge[at] += 1
    edge[at + window] -= 1
    return int((edge.cumsum()[:-1] > 0).sum())


def document_stats(text: bytes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """(base statistics, features) of UTF-8 bytes; empty bytes give zeros.

    Words are runs of bytes other than \\x20 and \\x09-\\x0D.
    """
    words = text.split()
    n = len(words)
    if not n:
        n_symbols = len(text) - len(text.translate(None, SYMBOLS))
        return (0, 0, n_symbols, 0, 0), (0.0,) * len(FEATURES)
    chars = len(text.translate(None, _CONTINUED))
    word_chars = chars - (len(text) - len(text.translate(None, _SPACE)))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    n_dup = len(lines) - len(set(lines))
    index = dict.fromkeys(words)
    for i, w in enumerate(index):
        index[w] = i
    codes = np.fromiter(map(index.__getitem__, words), np.int64, n)
    repeats = repeated_words(codes, len(index))
    counts = np.bincount(codes)
    lengths = [len(w) for w in index]
    single = sum(int(counts[i]) for i, size in enumerate(lengths) if size == 1)
    upper = len(text) - len(text.translate(None, _UPPER))
    lower = len(text) - len(text.translate(None, _LOWER))
    digits = len(text) - len(text.translate(None, _DIGITS))
    stops = len(text) - len(text.translate(None, _STOPS))
    same = int((codes[1:] == codes[:-1]).sum()) if n > 1 else 0
    features = (
        float(np.log1p(n)),
        word_chars / n,
        n_symbols / n,
        n_dup / len(lines),
        repeats / n,
        len(index) / n,
        float(counts.max()) / n,
        same / n,
        upper / max(1, upper + lower),
        digits / max(1, word_chars),
        len(_RUNS.findall(text)) / n,
        stops / n,
        float(np.log1p(n / len(lines))),
        single / n,
    )
    return (n, word_chars, n_symbols, n_dup, repeats), features
