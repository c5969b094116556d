"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

The features approximate a Gaussian kernel over standardised document statistics.  Each partition
sums its part of the normal equations; the parts are added by Spark, row by row of the matrix, and
the driver solves one system of a fixed size.  Isotonic regression on rows that the ridge has not
seen turns its scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.common import arrow_limits, map_rows, text_bytes, written
from listweave.llm.sample import labelled_sample, one_each
from listweave.llm.stats import FEATURES, document_stats

#: Labelled rows that the classifier is fitted on, at most.
FIT_ROWS = 10_000
#: Random features, kernel width in standard deviations, ridge penalty a row.
RANDOM_FEATURES, WIDTH, PENALTY, SEED = 192, 3.0, 1e-4, 20_240_501
#: A document is predicted 1 from this score on.
THRESHOLD = 0.3


@dataclass
class Ridge:
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.scale, self.omega, self.phase) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability: linear between the isotonic levels, flat beyond them."""
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, omega: np.ndarray, phase: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    out = np.empty((len(x), omega.shape[1] + 1))
    out[:, 0] = 1
    out[:, 1:] = np.sqrt(2 / omega.shape[1]) * np.cos(z @ omega + phase)
    return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and non-decreasing levels by pooling adjacent violators; each block gives its mean score.

    A block's mean takes half a row of each label with it, so that no level is exactly 0 or 1.
    """
    if not len(y):
        return np.array([0.0]), np.array([0.5])
    order = np.argsort(raw, kind="stable")
    r, v = raw[order], y[order].astype(float)
    blocks: list[list[float]] = []
    for a, b in zip(r, v, strict=True):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, t = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][2] += t
    s, n, t = np.array(blocks).T
    return t / n, np.maximum.accumulate((s + 0.5) / (n + 1))


def solved(gram: np.ndarray, moment: np.ndarray, rows: int) -> np.ndarray:
    """Weights of the ridge: the normal equations with the penalty of ``rows`` rows."""
    return np.linalg.solve(gram + PENALTY * rows * np.eye(len(gram)), moment)


def fit_ridge(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, parts: int = 12) -> Ridge:
    """Classifier of labels.quality from ``rows`` labelled documents at most (not held-out ones).

    Whole texts count, however long; of repeated rows of a document one counts; null texts are empty.
    Rows are dealt and ordered by id and the parts are summed as decimals, so that a fit repeats bit
    for bit.  Without rows apart for calibration the fitted ones serve.
    """
    spark = docs.sparkSession

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "label": batch.column(2), "x": [list(document_stats(t)[1]) for t in text_bytes(batch)]}

    seen = written(one_each(map_rows(labelled_sample(docs, labels, "quality", rows), "doc_id long, label int, x array<double>", run)), "ridge-sample")
    d = len(FEATURES)
    known = seen.toPandas().sort_values("doc_id")  # ``rows`` rows of statistics at most
    values, labels_of = np.array(known.x.tolist(), float).reshape(-1, d), known.label.to_numpy()
    rng = np.random.default_rng(SEED)
    omega = rng.normal(size=(d, RANDOM_FEATURES)) / WIDTH
    phase = rng.uniform(0, 2 * np.pi, RANDOM_FEATURES)
    size = RANDOM_FEATURES + 1
    if not len(known):
        return Ridge(np.zeros(d), np.ones(d), omega, phase, np.zeros(size), np.array([0.0]), np.array([0.5]))
    mean, scale = values.mean(0), values.std(0)
    scale[scale < 1e-9] = 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, n = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            if batch.num_rows:
                z = fourier(np.array(batch.column(1).to_pylist(), float), mean, scale, omega, phase)
                y = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
                a, b, n = a + z.T @ z, b + z.T @ y, n + len(y)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array([list(r) for r in np.column_stack([a, b])], pa.list_(pa.float64()))],
                names=["i", "row"],
            )

    arrow_limits(spark)
    fold = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4))
    dealt = seen.where(fold != 0).repartition(parts, "doc_id").sortWithinPartitions("doc_id")
    part = dealt.select("label", "x").mapInArrow(normal, "i int, row array<double>")
    sums = part.groupBy("i").agg(*[F.sum(F.col("row")[j].cast("decimal(38,18)")).alias(f"c{j}") for j in range(size + 1)]).toPandas().sort_values("i")
    if len(sums):
        m = sums.drop(columns="i").astype(float).to_numpy()
        weight = solved(m[:, :size], m[:, size], len(known))
    else:
        weight = np.zeros(size)
    ridge = Ridge(mean, scale, omega, phase, weight, np.array([0.0]), np.array([0.5]))
    apart = {r.doc_id for r in seen.where(fold == 0).select("doc_id").collect()}
    rest = known.doc_id.isin(apart).to_numpy() if apart else np.ones(len(known), bool)
    ridge.knots, ridge.levels = isotonic(ridge.raw(values[rest]), labels_of[rest])
    return ridge


def quality_scores(docs: DataFrame, ridge: Ridge, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row; a null text counts as empty and is scored as such.

    Whole texts count, however long; repeated rows and null ids each come back; an empty table gives an
    empty result; further columns, whatever their names, take no part.
    """

    def run(batch: pa.RecordBatch) -> dict:
        x = np.array([document_stats(t)[1] for t in text_bytes(batch, "t")], float).reshape(-1, len(FEATURES))
        score = ridge.score(x)
        return {"doc_id": batch.column(0), "score": score, "predicted": (score >= threshold).astype(np.int32)}

    return map_rows(docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")), "doc_id long, score double, predicted int", run)
