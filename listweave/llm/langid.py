"""Language identification: interpolated Kneser-Ney character models, one per language.

A model keeps, for each order, sorted arrays of 64-bit hashes: of the n-grams with their discounted
probabilities, and of the contexts with the weight that goes to the next lower order.  A text goes to
the language of the lowest cross-entropy per character; it is rejected if that cross-entropy lies
beyond what texts of the language that the model has not seen reach at its length.
"""

from __future__ import annotations

import functools
import math
import pickle
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listweave.llm.common import arrow_limits, held_out, map_rows, slices, written

ORDER = 4
#: Rows of each language that a model is fitted on, at most, what of a longer text is used, and
#: characters of all of them, so that a model is bounded however long the texts are.
FIT_ROWS, FIT_CHARS, FIT_TOTAL = 500, 30_000, 1_000_000
#: Bytes of all models together that the driver and the broadcast accept.
MODEL_BYTES = 256 << 20
#: Scatter of a single character's entropy, in nats, that a model assumes at least.
LEAST_SCATTER = 2.0
#: Characters of the pieces from which the spread of short texts is estimated.
PIECE = 40
#: A text this many standard deviations beyond the usual cross-entropy is rejected.
REJECT_SDS = 6.0
#: Sharpness of the score; 1 would be odds for a single character.
SHARPNESS = 12.0
UNKNOWN = "und"
_SPACE = 32
_MULT = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _kinds() -> np.ndarray:
    """By code point: 1 letter, 2 mark that goes with a letter, 0 anything else."""
    first = {"L": 1, "M": 2}
    return np.array([first.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts with every run of non-letters as one space.

    Returns (code points, start of each text, number of texts' letters); a text starts with a space
    only inside its context, never in the array, and a text without letters is empty.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in lowered], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    kind = _kinds()[points]
    word = kind > 0
    # a space stays if a letter of the same text precedes it
    keep = word.copy()
    keep[1:] |= ~word[1:] & word[:-1] & (doc[1:] == doc[:-1])
    out = np.where(word, points, np.uint32(_SPACE))[keep]
    size = np.bincount(doc[keep], minlength=len(texts))
    n_letters = np.bincount(doc[kind == 1], minlength=len(texts))
    return out, np.concatenate([[0], size.cumsum()]), n_letters


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def gram_hash(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points."""
    h = np.full(len(grams), grams.shape[1] + 1, np.uint64)
    for j in range(grams.shape[1]):
        h = _mix(h * _MULT + grams[:, j].astype(np.uint64) + np.uint64(1))
    return h


def grams_of(points: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """(character, order) code points: each character with those before it, spaces before a text."""
    n = len(points)
    pos = np.arange(n) - np.repeat(starts[:-1], np.diff(starts))
    out = np.full((n, order), _SPACE, np.uint32)
    out[:, order - 1] = points
    for back in range(1, order):
        ok = pos >= back
        out[ok, order - 1 - back] = points[np.flatnonzero(ok) - back]
    return out


@dataclass
class CharModel:
    """For each order 1..n: n-gram hashes and probabilities, context hashes and weights."""

    vocabulary: int
    orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    mean: float = 0.0
    spread: float = 1.0
    spread_char: float = 1.0

    def log_prob(self, grams: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each row's last character after the others."""
        p = np.full(len(grams), 1 / self.vocabulary)
        top = grams.shape[1]
        for n, (h, alpha, ctx, gamma) in enumerate(self.orders, 1):
            own = grams[:, top - n :]
            p = _lookup(h, alpha, gram_hash(own), 0.0) + _lookup(ctx, gamma, gram_hash(own[:, :-1]), 1.0) * p
        return np.log(p)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def fit_model(texts: list[str], vocabulary: int, order: int = ORDER) -> CharModel:
    """Interpolated Kneser-Ney model: counts at the top order, numbers of left neighbours below it."""
    model = CharModel(vocabulary)
    points, starts, _ = letters(texts)
    grams = grams_of(points, starts, order)
    h, first, count = np.unique(gram_hash(grams), return_index=True, return_counts=True)
    types, count = grams[first], count.astype(float)
    for n in range(order, 0, -1):
        n1, n2 = (count == 1).sum(), (count == 2).sum()
        discount = n1 / (n1 + 2 * n2) if n1 else 0.5
        discount = min(max(discount, 0.05), 0.95)
        ch = gram_hash(types[:, :-1])
        ctx, back = np.unique(ch, return_inverse=True)
        total = np.bincount(back, count, len(ctx))
        kinds = np.bincount(back, minlength=len(ctx))
        alpha = (count - discount) / total[back] if len(ctx) else count
        gamma = discount * kinds / total if len(ctx) else total
        order_h = gram_hash(types)
        by = np.argsort(order_h)
        model.orders.insert(0, (order_h[by], alpha[by], ctx, gamma))
        if n > 1:  # each type of this order counts once for the types one shorter
            lower = gram_hash(types[:, 1:])
            _, first, count = np.unique(lower, return_index=True, return_counts=True)
            types, count = types[first][:, 1:], count.astype(float)
    return model


@dataclass
class Languages:
    names: list[str]
    models: list[CharModel]
    order: int = ORDER

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cross-entropy of each text in each language, characters, letters); no letter: zeros."""
        points, starts, n_letters = letters(texts)
        size = np.diff(starts)
        out = np.zeros((len(texts), len(self.models)))
        if len(points) and self.models:
            grams = grams_of(points, starts, self.order)
            code, _ = pd.factorize(gram_hash(grams))
            # first occurrence of each code, to look its characters up
            first = np.full(code.max() + 1, -1)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            types = grams[first]
            has = size > 0
            for j, m in enumerate(self.models):
                out[has, j] = -np.add.reduceat(m.log_prob(types)[code], starts[:-1][has]) / size[has]
        return out, size, n_letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score from 0 to 1, rejected) of each text; ``und``, 0, True without a letter."""
        ce, size, n_letters = self.entropies(texts)
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        best = ce.argmin(1)
        low = ce[np.arange(len(ce)), best]
        score = 1 / np.exp(-SHARPNESS * (ce - low[:, None])).sum(1)
        mean = np.array([m.mean for m in self.models])[best]
        wide = np.array([m.spread for m in self.models])[best]
        char = np.array([m.spread_char for m in self.models])[best]
        limit = mean + REJECT_SDS * np.sqrt(wide**2 + char**2 / np.maximum(size, 1))
        none = n_letters == 0
        score[none] = 0
        lang = [UNKNOWN if x else self.names[i] for x, i in zip(none, best, strict=True)]
        return lang, score, none | (low > limit)


def _fit_group(frame: pd.DataFrame, vocabulary: int) -> CharModel:
    """Model of three quarters of the texts, its usual cross-entropy from the rest; then of all."""
    frame = frame.sort_values("doc_id", kind="stable")
    texts = frame.text.tolist()
    rest = texts[::4] if len(texts) > 3 else texts
    seen = [t for i, t in enumerate(texts) if i % 4] or texts
    held = Languages(["x"], [fit_model(seen, vocabulary)])
    ce, size, _ = held.entropies(rest)
    ce, size = ce[size > 0, 0], size[size > 0]
    model = fit_model(texts, vocabulary)
    if len(ce):
        middle = float(np.median(ce))
        model.mean = middle
        model.spread = max(0.1, 1.4826 * float(np.median(np.abs(ce - middle))))
        # what a text's entropy scatters by beyond that because it is short, from pieces of those texts
        cut = [t[i : i + PIECE] for t in rest for i in range(0, len(t), PIECE)][:20_000]
        pe, n, _ = held.entropies(cut)
        whole = n >= PIECE // 2
        if whole.any():
            off, n = np.abs(pe[whole, 0] - middle), n[whole]
            scatter = (1.4826 * float(np.median(off))) ** 2 - model.spread**2
            model.spread_char = max(LEAST_SCATTER, math.sqrt(max(0.0, scatter * float(np.median(n)))))
    return model


def fit_languages(docs: DataFrame, rows: int = FIT_ROWS, chars: int = FIT_CHARS, total: int = FIT_TOTAL) -> Languages:
    """A model for each non-null lang of the rows that are not held out.

    It rests on ``rows`` rows a language at most, with a letter and of the smallest id hashes; texts of
    up to ``chars`` characters come first, and of longer ones, where those do not suffice, the first
    ``chars`` are used, for fitting only.  Rows after the first count while their characters sum to
    ``total`` at most, so a model is bounded by that many n-grams an order.  Of repeated rows of a
    document in a language one counts.  More than ``MODEL_BYTES`` of models raise a ValueError.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    usable = base.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    usable = usable.withColumn("long", F.length("text") > chars).withColumn("text", F.substring("text", 1, chars)).where(F.col("text").rlike(r"\p{L}"))
    # rows of the smallest hashes: counts by slice of the hash order, coarse and then fine, say how far
    # to look in each language, so that no task orders a language's rows, however many there are
    own = F.xxhash64(F.lit(13), "doc_id")
    first = F.lit(-(1 << 63)).cast("long")
    h = F.when(F.col("long"), own.bitwiseAND((1 << 63) - 1)).otherwise(own.bitwiseOR(first))  # longer texts after all others
    named = usable.select("doc_id", "lang", h.alias("h"), F.length("text").alias("n_chars"))
    near = written(named.groupBy("doc_id", "lang").agg(F.min(F.struct("h", "n_chars")).alias("m")).select("doc_id", "lang", "m.*"), "langid-ids")
    for bits in (10, 20):
        upto = Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        sliced = near.withColumn("slice", F.shiftright("h", 64 - bits))
        counts = sliced.groupBy("lang", "slice").agg(F.count("*").alias("n"))
        cuts = counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).where(F.col("before") < rows)
        cuts = cuts.groupBy("lang").agg(F.max("slice").alias("last"))
        near = sliced.join(F.broadcast(cuts), "lang").where("slice <= last").drop("slice", "last")  # cuts: a row a language
    line = Window.partitionBy("lang").orderBy("h", "doc_id")
    upto = F.sum("n_chars").over(line.rowsBetween(Window.unboundedPreceding, 0))
    placed = near.withColumns({"n": F.row_number().over(line), "upto": upto})
    ids = placed.where((F.col("n") <= rows) & ((F.col("n") == 1) | (F.col("upto") <= total))).select("doc_id", "lang")
    vocabulary = 1024

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [frame.lang.iloc[0]], "model": [pickle.dumps(_fit_group(frame, vocabulary))]})

    arrow_limits(spark)
    sample = usable.join(F.broadcast(ids), ["doc_id", "lang"])  # ids: ``rows`` longs a language at most
    # one text a document: partial minima of the partitions are all that meets
    sample = sample.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    models = written(sample.groupBy("lang").applyInPandas(fit, "lang string, model binary"), "langid-models")
    size = models.agg(F.coalesce(F.sum(F.octet_length("model")), F.lit(0)).alias("n")).first().n
    if size > MODEL_BYTES:
        raise ValueError(f"the models of all languages take {size} bytes, over {MODEL_BYTES}: lower FIT_TOTAL")
    got = models.collect()
    got.sort(key=lambda r: r.lang)
    return Languages([r.lang for r in got], [pickle.loads(r.model) for r in got])


def languages_of(docs: DataFrame, found: Languages, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of every row with _lang, _score and _rejected.

    A null text or one without a letter is ``und``, 0, rejected; whole texts count, however long;
    repeated rows each come back; a tie goes to the language that sorts first; an empty table gives an
    empty result, and without any learned language all rows are ``und``.  The results take the place of
    columns in ``keep`` that have their names.
    """
    keep = ["doc_id"] if keep is None else keep
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(found)

    def run(batch: pa.RecordBatch) -> dict:
        texts = [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]
        lang, score, rejected = [], [], []
        for a, b in slices([4 * len(t) for t in texts]):
            got = shared.value.predict(texts[a:b])
            lang += got[0]
            score.append(got[1])
            rejected.append(got[2])
        own = {f"c{i}": batch.column(i) for i in range(len(keep))}
        return own | {"_lang": lang, "_score": np.concatenate(score), "_rejected": np.concatenate(rejected)}

    given = docs.select(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keep)], F.col(text).alias("t"))
    kinds = ", ".join(f"c{i} {given.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    out = map_rows(given, f"{kinds}, _lang string, _score double, _rejected boolean", run)
    results = ("_lang", "_score", "_rejected")
    return out.select(*[F.col(f"c{i}").alias(k) for i, k in enumerate(keep) if k not in results], *results)


def known_languages(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns, whatever their names.

    Rows with a null text or no letter go; null ids and langs, repeated rows and empty tables are as in
    ``languages_of``.
    """
    names = docs.columns
    plain = docs.toDF(*[f"own{i}" for i in range(len(names))])
    own = plain.columns
    judged = languages_of(plain, fit_languages(docs), text=own[names.index("text")], keep=own)
    return judged.where(~F.col("_rejected")).select(*own).toDF(*names)
