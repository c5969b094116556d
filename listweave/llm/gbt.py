"""Quality rules: gradient-boosted trees over document statistics, flattened into node arrays.

Trees are grown on histograms with a logistic loss.  Features with a constraint move the score in
one direction only: a split that would break it is refused, and the children of a constrained split
are bounded by the midpoint of their weights, as are all nodes below them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.common import map_rows, text_bytes
from listweave.llm.sample import labelled_sample, one_each
from listweave.llm.stats import BASE, FEATURES, document_stats

#: Labelled rows that the trees are fitted on, at most.
FIT_ROWS = 10_000
#: -1: more of it never raises the score.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "same_word_share": -1, "shout_rate": -1}
#: Documents under this score are not kept.
THRESHOLD = 0.3


@dataclass
class Trees:
    """All trees in five arrays; node i is a leaf if left[i] == i."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: all rows go down all trees, a level at a time."""
        node = np.repeat(self.roots[None, :], len(x), 0)
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[row, self.feature[node]] <= self.cut[node]
            node = np.where(low, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(1))))


def fit_trees(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2,
    bins: int = 32, l2: float = 1.0, min_rows: int = 10,
) -> Trees:
    """Boosted trees for labels 0/1; without rows or with one label the score is a constant."""
    n = len(y)
    share = (float(y.sum()) + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []
    roots: list[int] = []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        coded = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        margin = np.full(n, base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = y - p, p * (1 - p)

            def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
                at = len(nodes)
                weight = lambda g, h: float(np.clip(g / (h + l2), low, high))
                g, h = grad[rows].sum(), hess[rows].sum()
                nodes.append([0, np.inf, at, at, rate * weight(g, h)])
                best = (1e-6, None)
                if level < depth and len(rows) >= 2 * min_rows:
                    for j, e in enumerate(edges):
                        if not len(e):
                            continue
                        c = coded[rows, j]
                        gl = np.bincount(c, grad[rows], len(e) + 1).cumsum()[:-1]
                        hl = np.bincount(c, hess[rows], len(e) + 1).cumsum()[:-1]
                        nl = np.bincount(c, minlength=len(e) + 1).cumsum()[:-1]
                        wl, wr = np.clip(gl / (hl + l2), low, high), np.clip((g - gl) / (h - hl + l2), low, high)
                        gain = (gl * wl - (hl + l2) * wl * wl / 2) + ((g - gl) * wr - (h - hl + l2) * wr * wr / 2)
                        w0 = weight(g, h)
                        gain -= g * w0 - (h + l2) * w0 * w0 / 2
                        gain[(nl < min_rows) | (len(rows) - nl < min_rows)] = -np.inf
                        if monotone[j]:
                            gain[monotone[j] * (wr - wl) < 0] = -np.inf
                        k = int(np.argmax(gain))
                        if gain[k] > best[0]:
                            best = (float(gain[k]), (j, k, float(wl[k]), float(wr[k])))
                if best[1] is None:
                    return at
                j, k, wl, wr = best[1]
                mid = (wl + wr) / 2
                bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[int(monotone[j])]
                go = coded[rows, j] <= k
                nodes[at][:2] = [j, float(edges[j][k])]
                nodes[at][2] = grow(rows[go], level + 1, *bounds[0])
                nodes[at][3] = grow(rows[~go], level + 1, *bounds[1])
                return at

            roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
            flat = _flat(nodes, roots[-1:], depth, 0.0)
            margin = margin + np.log(flat.score(x) / (1 - flat.score(x)))
    return _flat(nodes, roots, depth, base)


def _flat(nodes: list[list], roots: list[int], depth: int, base: float) -> Trees:
    if not nodes:
        nodes, roots = [[0, np.inf, 0, 0, 0.0]], [0]
    f, c, a, b, v = zip(*nodes, strict=True)
    return Trees(np.array(f), np.array(c, float), np.array(a), np.array(b), np.array(v, float), np.array(roots), depth, base)


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees:
    """Trees for labels.quality, fitted on ``rows`` labelled documents at most (not held-out ones).

    Whole texts count, however long; of repeated rows of a document one counts; null texts are empty.
    """

    def run(batch: pa.RecordBatch) -> dict:
        stats = [document_stats(x)[1] for x in text_bytes(batch)]
        return {"label": batch.column(2), "x": [list(s) for s in stats], "doc_id": batch.column(0)}

    sample = map_rows(labelled_sample(docs, labels, "quality", rows), "doc_id long, label int, x array<double>", run)
    got = one_each(sample).toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got.x.tolist(), float).reshape(len(got), len(FEATURES))
    return fit_trees(x, got.label.to_numpy(float), np.array([MONOTONE.get(f, 0) for f in FEATURES]))


def quality_rules(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base statistics, base_failed, rule score and kept of every row of ``docs``.

    base_failed: under 10 words, or over a fifth of the words in repeated 5-word windows.  kept is
    false if base_failed, else score >= threshold.  A null or empty text has zeros and is not kept;
    whole texts count, however long; repeated rows and null ids each come back; an empty table gives an
    empty result; further columns, whatever their names, take no part.
    """

    def run(batch: pa.RecordBatch) -> dict:
        got = [document_stats(x) for x in text_bytes(batch, "t")]
        base = np.array([g[0] for g in got], np.int64).reshape(-1, len(BASE))
        score = trees.score(np.array([g[1] for g in got], float).reshape(-1, len(FEATURES)))
        failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
        return {"doc_id": batch.column(0)} | {k: base[:, i] for i, k in enumerate(BASE)} | {
            "base_failed": failed, "kept": ~failed & (score >= threshold), "score": score
        }

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in BASE) + ", base_failed boolean, kept boolean, score double"
    return map_rows(docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")), schema, run)
