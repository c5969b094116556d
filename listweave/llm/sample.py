"""Bounded samples of labelled rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents, those of the smallest id hashes.

    Held-out rows and null ids or labels are left out, as are ids with two different labels.  Repeated
    rows of a document all come; ``one_each`` takes one of them once they are features.  Only the
    sampled ids, at most ``rows`` longs, are broadcast, so the documents are read once and not shuffled.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id")
        .limit(rows)
        .select("doc_id", "label")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label")


def one_each(features: DataFrame) -> DataFrame:
    """One row (doc_id, label, x) an id, the smallest x, so that at most the sampled ids are left.

    Rows of an id meet as partial minima of a partition each.
    """
    return features.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x"))
