"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listweave.llm.common import held_out, read_table


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.mixing import mix_corpus

    return mix_corpus(read_table(spark, sf_dir, "documents"))


def op2_sql() -> str:
    """The mix in SQL: shares level by level, then each leaf's prefix in md5 order."""
    from listweave.llm.mixing import BYTES_A_TOKEN, CORPUS_MIX, DOMAINS

    m = CORPUS_MIX
    cases = " ".join(f"WHEN source IN ({', '.join(repr(f'src{i}') for i in r)}) THEN '{d}'" for d, r in DOMAINS.items())
    parts = [
        f"""docs AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, CASE {cases} ELSE 'other' END AS domain, coalesce(lang, 'unknown') AS lang,
          coalesce(source, 'unknown') AS source, CAST((coalesce(strlen(text), 0) + {BYTES_A_TOKEN - 1}) // {BYTES_A_TOKEN} AS BIGINT) AS tokens FROM documents)""",
        "leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS HUGEINT) AS tokens FROM docs GROUP BY ALL)",
        f"g0 AS (SELECT coalesce(sum(tokens), 0) * {m.share[0]} // {m.share[1]} AS got FROM leaves)",
    ]
    for depth in range(1, 4):
        path, up = ", ".join(m.levels[:depth]), m.levels[: depth - 1]
        level = m.levels[depth - 1]
        known = m.weights.get(level, {})
        weight = f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in known.items()) + f" ELSE {m.default} END" if known else str(m.default)
        by = "PARTITION BY " + ", ".join(up) if up else ""
        line = f"({by} ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE), {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        using = f"JOIN g{depth - 1} USING ({', '.join(up)})" if up else f"CROSS JOIN g{depth - 1}"
        parts += [
            f"c{depth} AS (SELECT {path}, CAST(sum(tokens) AS HUGEINT) * {m.epochs} AS capacity, CAST({weight} AS HUGEINT) AS weight FROM leaves GROUP BY {path})",
            f"""f{depth} AS (SELECT *, capacity * (sum(weight) OVER ({by}) - coalesce(sum(weight) OVER {line}, 0))
                <= (got - coalesce(sum(capacity) OVER {line}, 0)) * weight AS is_full FROM c{depth} {using})""",
            f"""g{depth} AS (SELECT {path}, CASE WHEN is_full THEN capacity ELSE least(capacity,
                (got - coalesce(sum(capacity) FILTER (is_full) OVER ({by}), 0)) * weight // nullif(coalesce(sum(weight) FILTER (NOT is_full) OVER ({by}), 0), 0)) END AS got FROM f{depth})""",
        ]
    parts.append(
        f"""drawn AS (SELECT d.*, coalesce(g.got // nullif(l.tokens, 0), 0) AS whole, coalesce(g.got % nullif(l.tokens, 0), 0) AS rest,
          md5(concat({m.seed}, ':', coalesce(g.got // nullif(l.tokens, 0), 0), ':', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS place
          FROM docs d JOIN leaves l USING (domain, lang, source) JOIN g3 g USING (domain, lang, source))"""
    )
    return "WITH " + ",\n".join(parts) + """
SELECT doc_id, domain, lang, source, tokens,
       CAST(whole + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END AS BIGINT) AS epochs
FROM drawn"""


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.simhash import near_duplicates

    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.gbt import fit_quality, quality_rules

    docs = read_table(spark, sf_dir, "documents")
    return quality_rules(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.ridge import fit_ridge, quality_scores

    docs = read_table(spark, sf_dir, "documents")
    scored = quality_scores(docs, fit_ridge(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.langid import fit_languages, languages_of

    docs = read_table(spark, sf_dir, "documents")
    found = languages_of(docs, fit_languages(docs), keep=["doc_id"])
    return found.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_rejected").alias("rejected"),
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.repeats import cut_repeats

    cut = cut_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.size("_spans").cast("long").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.htmltext import extract

    return extract(read_table(spark, sf_dir, "pages"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from listweave.llm.bpe import encode_documents

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_documents(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op4_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.warc import round_trip

    return round_trip(read_table(spark, sf_dir, "pages")).drop("payload", "url")


OP4_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper FROM p
)
SELECT page_id,
       CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM d
"""


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listweave.llm.topk import top_k, vector_rows

    return top_k(vector_rows(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0), 20)


OP5_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.place <> c.place WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_mixing": op2_mixing,
        "op3_simhash_near_dedup": op3_simhash_near_dedup,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_language_id": op7_language_id,
        "op8_suffix_array_dedup": op8_suffix_array_dedup,
        "op9_html_extraction": op9_html_extraction,
        "op10_byte_bpe": op10_byte_bpe,
        "op4_warc_zstd": op4_warc_zstd,
        "op5_exact_top_k": op5_exact_top_k,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": op2_sql(),
        "op4_warc_zstd": OP4_SQL,
        "op5_exact_top_k": OP5_SQL,
    }
