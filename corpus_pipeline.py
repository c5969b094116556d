"""A corpus from raw documents: five stages, each written as Parquet and read again by the next.

``STAGES`` holds (name, function) pairs; each function takes (spark, docs, sf_dir).  All but the last
return the columns of documents.  Counted as part of the subpackage ``listweave.llm``.
"""

from __future__ import annotations

from dataclasses import replace

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from listweave.llm.bpe import encode_documents
from listweave.llm.common import read_table, written
from listweave.llm.langid import known_languages
from listweave.llm.mixing import CORPUS_MIX, mixed_documents
from listweave.llm.nearcopies import keep_one_copy
from listweave.llm.repeats import without_repeats

#: The pipeline takes each document once at most and a tenth less than all tokens, so that the
#: weights have room to act without repeating what the stages before have made unique.
PIPELINE_MIX = replace(CORPUS_MIX, share=(9, 10), epochs=1)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those that every language model rejects go.

    Null texts and texts without a letter are rejected; null ids, langs and sources stay as they are,
    repeated rows each stay, a tie goes to the language that sorts first; empty tables stay empty.
    """
    return known_languages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word Jaccard of 0.8 or more): the smallest doc_id.

    SimHash over five-word shingles proposes, whole sets verify, an exact prefix filter finds what lies
    further apart.  Null and empty texts are equal to each other; of repeated rows of a doc_id one
    stays; rows without a doc_id stay; empty tables stay empty.
    """
    return keep_one_copy(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document also holds.

    Null texts stay null and rows without a doc_id stay whole; repeated rows of a doc_id leave each
    other alone; a text that is all repeated becomes empty; empty tables stay empty.
    """
    return without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of domains, languages and sources.

    Null langs and sources are ``unknown``, null texts have no tokens; repeated rows of a doc_id are
    taken together, ties in the order go by doc_id; empty tables stay empty.
    """
    return mixed_documents(docs, PIPELINE_MIX)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document, however long.

    Null texts are empty; repeated rows and null ids each come back; an empty table gives an empty result.
    """
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("mixing", mixing),
    ("tokenise", tokenise),
]

#: Language models, components and tokens have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
