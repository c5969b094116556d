"""State tables of the listing engine, derived from the driver's tables.

Each text is SQL that both Spark and DuckDB run as it stands, so that the operators and their checks
start from equal rows.  ``AS_OF`` is the time of all reports.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

AS_OF = datetime(2001, 7, 31, 12, 0, 0)
TS = "TIMESTAMP '2001-07-31 12:00:00'"

#: Id of a line: order, line, part and supplier, as order and line alone repeat.
_LINE = "(l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey % 100000 * 10000 + l_suppkey % 10000"

VIEWS: dict[str, str] = {
    "src": "SELECT CAST(n_nationkey AS BIGINT) AS id, concat('src', CAST(n_nationkey AS STRING)) AS code, concat('Source ', CAST(n_nationkey AS STRING)) AS display_name FROM nation WHERE n_nationkey < 9",
    "jobs": """
      SELECT o_orderkey AS id, concat('src', CAST(o_custkey % 9 AS STRING)) AS source,
             concat('https://site.example/job/', CAST(o_orderkey AS STRING), '?utm_source=x') AS url,
             CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'expired' ELSE 'unknown' END AS listing_status,
             CASE WHEN o_orderkey % 11 = 0 THEN 'fetching' WHEN o_orderkey % 13 = 0 THEN 'storage_missing'
                  WHEN o_orderpriority = '1-URGENT' THEN 'pending' WHEN o_orderpriority = '2-HIGH' THEN 'retryable_error'
                  WHEN o_orderpriority = '3-MEDIUM' AND o_orderkey % 2 = 0 THEN 'permanent_error' ELSE 'raw_ready' END AS raw_status,
             CASE WHEN o_orderkey % 5 < 2 THEN 'timeout' WHEN o_orderkey % 5 = 2 THEN 'http' END AS last_error_type,
             CASE WHEN o_orderkey % 5 = 2 THEN 503 WHEN o_orderkey % 5 = 3 THEN 404 END AS last_http_status,
             o_orderdate AS first_seen_at, o_orderdate + INTERVAL '20' DAY AS last_seen_at, o_orderdate + INTERVAL '3' DAY AS last_attempt_at,
             CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate + INTERVAL '4' DAY END AS next_retry_at, o_orderdate + INTERVAL '5' DAY AS updated_at,
             CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '30' DAY END AS expired_at,
             CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS BIGINT) END AS expired_run_id,
             CAST(o_orderkey % 4 AS INT) AS fetch_attempt_count, CAST(o_orderkey % 3 AS BIGINT) AS last_seen_run_id,
             CASE WHEN o_orderkey % 7 > 0 THEN concat('scope', CAST((o_custkey % 9) % 3 AS STRING)) END AS tracking_scope_hash
      FROM orders""",
    "raw_objects": """
      SELECT CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey * 10 ELSE -10 * o_orderkey END AS id, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey ELSE -o_orderkey END AS job_id, concat('key-', CAST(o_orderkey AS STRING)) AS object_key, 'raw' AS bucket_name,
             md5(CAST(o_orderkey AS STRING)) AS content_sha256, CAST(floor(o_totalprice) AS BIGINT) AS content_length_bytes,
             o_orderdate + INTERVAL '1' DAY AS stored_at, o_orderdate + INTERVAL '1' DAY AS fetched_at,
             CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate + INTERVAL '90' DAY END AS purged_at
      FROM orders""",
    "postings": """
      SELECT o_orderkey + 1000000 AS id, CAST(o_custkey % 9 AS BIGINT) AS source_id, concat('https://site.example/job/', CAST(o_orderkey AS STRING)) AS canonical_url,
             o_orderkey AS crawler_job_id, o_orderdate AS first_seen_at, o_orderdate + INTERVAL '20' DAY AS last_seen_at
      FROM orders""",
    "results": f"""
      SELECT {_LINE} AS id, l_orderkey + 1000000 AS source_posting_id, l_orderkey * 10 AS crawler_raw_object_id, l_orderkey AS job_id,
             CASE WHEN l_partkey % 6 = 0 THEN 'other' ELSE md5(CAST(l_orderkey AS STRING)) END AS raw_sha256, 'raw' AS raw_bucket, concat('key-', CAST(l_orderkey AS STRING)) AS raw_object_key,
             CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'partial' ELSE 'rejected' END AS quality_status,
             CAST(floor(l_quantity) * 2 AS INT) AS completeness_score, l_linenumber = 1 AS is_current, l_shipdate AS fetched_at,
             CASE WHEN l_suppkey % 9 = 0 THEN '  ' WHEN l_suppkey % 10 = 0 THEN NULL ELSE concat('Engineer ', CAST(l_partkey % 50 AS STRING)) END AS title,
             CASE WHEN l_suppkey % 7 > 0 THEN concat('Company ', CAST(l_suppkey AS STRING)) END AS employer_name_raw,
             CASE WHEN l_partkey % 5 > 0 THEN concat('Build things ', CAST(l_partkey AS STRING)) END AS description_text,
             CASE WHEN l_partkey % 3 > 0 THEN 'Know things' END AS requirements_text, CASE WHEN l_partkey % 4 = 0 THEN ' ' WHEN l_partkey % 4 = 1 THEN 'Bonus' END AS benefits_text,
             CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS STRING) END AS salary_raw, CASE WHEN l_partkey % 2 = 0 THEN 'full time' END AS employment_type_raw,
             CASE WHEN l_partkey % 7 = 0 THEN '3 years' END AS experience_raw,
             CASE WHEN l_partkey % 8 > 4 THEN l_shipdate END AS posted_at, CASE WHEN l_partkey % 8 > 5 THEN l_shipdate + INTERVAL '30' DAY END AS expires_at
      FROM lineitem""",
    "parse_attempts": f"""
      SELECT {_LINE} AS id, l_orderkey AS job_id, l_orderkey * 10 AS raw_object_id, 'page' AS parser_name,
             concat('1.', CAST(l_linenumber % 2 AS STRING)) AS parser_version, l_linenumber AS attempt_number,
             CASE WHEN l_linestatus = 'O' AND l_partkey % 9 = 0 THEN 'parsing' WHEN l_returnflag = 'A' THEN 'success' WHEN l_returnflag = 'N' THEN 'validation_error' ELSE 'parse_error' END AS status,
             CASE WHEN l_returnflag = 'R' THEN 'ValueError' WHEN l_returnflag = 'N' THEN 'Missing' END AS error_type, l_shipdate AS started_at
      FROM lineitem""",
    "fetch_attempts": f"""
      SELECT {_LINE} AS id, l_orderkey AS job_id, CASE WHEN l_returnflag = 'A' THEN 'success' WHEN l_returnflag = 'N' THEN 'fetch_error' ELSE 'blocked' END AS status,
             CASE WHEN l_returnflag = 'N' THEN 'timeout' END AS error_type, CASE WHEN l_returnflag = 'R' THEN 403 WHEN l_returnflag = 'A' THEN 200 END AS http_status, l_shipdate AS started_at
      FROM lineitem""",
    "runs": """
      SELECT CAST(c_custkey AS BIGINT) AS id, concat('src', CAST(c_custkey % 9 AS STRING)) AS source,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'full' WHEN 'HOUSEHOLD' THEN 'detail' WHEN 'MACHINERY' THEN 'parse' ELSE 'discovery' END AS phase,
             CASE WHEN c_custkey % 10 < 7 THEN 'completed' WHEN c_custkey % 10 = 7 THEN 'failed' ELSE 'running' END AS status,
             CASE WHEN c_nationkey % 5 = 0 THEN 'skipped' WHEN c_nationkey % 5 = 1 THEN 'baseline' WHEN c_nationkey % 5 = 2 THEN 'pending' ELSE 'applied' END AS cdc_status,
             CASE WHEN c_nationkey % 5 = 0 THEN 'zero_urls' END AS cdc_reason, c_nationkey % 5 IN (1, 3, 4) AS coverage_complete,
             concat('scope', CAST((c_custkey % 9) % 3 AS STRING)) AS scope_hash,
             TIMESTAMP '2001-01-01 00:00:00' + CAST(c_custkey % 210 AS INT) * INTERVAL '1' DAY AS started_at,
             TIMESTAMP '2001-01-01 06:00:00' + CAST(c_custkey % 210 AS INT) * INTERVAL '1' DAY AS finished_at,
             TIMESTAMP '2001-01-01 06:30:00' + CAST(c_custkey % 210 AS INT) * INTERVAL '1' DAY AS cdc_finished_at,
             CAST(c_custkey % 40 AS BIGINT) AS discovered_url_count, CAST(c_custkey % 7 AS BIGINT) AS new_url_count,
             CAST(c_custkey % 5 AS BIGINT) AS expired_url_count, CAST(c_custkey % 3 AS BIGINT) AS reappeared_url_count
      FROM customer""",
    "scopes": "SELECT concat('src', CAST(n_nationkey AS STRING)) AS source, concat('scope', CAST(n_nationkey % 3 AS STRING)) AS scope_hash, CAST(n_nationkey + 9 AS BIGINT) AS last_applied_run_id FROM nation WHERE n_nationkey < 7",
    "queue": """
      SELECT c_custkey AS id, CAST(c_custkey + 1000000 AS BIGINT) AS source_posting_id, md5(CAST(c_custkey AS STRING)) AS input_hash, 'v1' AS schema_version, 'v1' AS prompt_version,
             CASE c_custkey % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'succeeded' WHEN 3 THEN 'retry_wait' WHEN 4 THEN 'failed' ELSE 'superseded' END AS status,
             CAST(c_custkey % 4 AS INT) AS attempts, TIMESTAMP '2001-07-01 00:00:00' + CAST(c_custkey % 60 AS INT) * INTERVAL '1' DAY AS next_attempt_at
      FROM customer""",
    "ledger": """
      SELECT event_id AS id, concat('provider', CAST(user_id % 3 AS STRING)) AS provider, CASE WHEN user_id % 2 = 0 THEN 'large' ELSE 'small' END AS model, ts AS started_at,
             CAST(floor(value * 10) AS BIGINT) + 100 AS reserved_tokens, CASE WHEN event_id % 5 > 0 THEN CAST(floor(value * 8) AS BIGINT) + 10 END AS actual_tokens,
             CAST(floor(value * 7) AS BIGINT) AS input_tokens, CAST(floor(value * 20) AS BIGINT) + 1 AS input_bytes, CAST(1 + event_id % 3 AS INT) AS item_count
      FROM events""",
    "listings": """
      SELECT doc_id AS id, CAST(doc_id % 9 AS BIGINT) AS source_id, concat('src', CAST(doc_id % 9 AS STRING)) AS source_code, concat('Source ', CAST(doc_id % 9 AS STRING)) AS source_name,
             text AS title, source AS employer_name_raw, concat('https://site.example/', CAST(doc_id AS STRING)) AS canonical_url,
             CASE WHEN doc_id % 4 = 0 THEN array('Python', 'Postgres') WHEN doc_id % 4 = 1 THEN array('C++', 'Java') ELSE array('SQL') END AS skills_raw,
             array(lang) AS categories_raw,
             CASE doc_id % 5 WHEN 0 THEN array('Hà Nội', 'Đà Nẵng') WHEN 1 THEN array('Hồ Chí Minh') WHEN 2 THEN array(' ') ELSE array('Huế') END AS location_cities,
             CASE WHEN doc_id % 3 = 0 THEN NULL ELSE TIMESTAMP '2001-07-01 00:00:00' + CAST(doc_id % 31 AS INT) * INTERVAL '1' DAY END AS posted_at,
             TIMESTAMP '2001-06-20 00:00:00' + CAST(doc_id % 40 AS INT) * INTERVAL '1' DAY AS first_seen_at, TIMESTAMP '2001-07-30 00:00:00' AS last_seen_at,
             CASE WHEN doc_id % 6 = 5 THEN 'not_enriched' ELSE 'succeeded' END AS enrichment_status,
             CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(doc_id % 7 AS DOUBLE) - 1 END AS experience_min_years, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 9 AS DOUBLE) END AS experience_max_years,
             CASE doc_id % 4 WHEN 0 THEN array('junior', 'middle') WHEN 1 THEN array('senior', 'guru') WHEN 2 THEN array('guru') END AS seniority_levels,
             CASE doc_id % 5 WHEN 0 THEN 'remote' WHEN 1 THEN 'onsite' WHEN 2 THEN 'hybrid' WHEN 3 THEN 'moon' END AS work_mode,
             CASE WHEN doc_id % 4 = 0 THEN array('Python', 'Postgres', 'PostgreSQL') WHEN doc_id % 4 = 1 THEN array('C++', 'juggling') END AS skills_required,
             CASE WHEN doc_id % 2 = 0 THEN array('SQL', 'postgres') END AS skills_preferred
      FROM documents""",
}

_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A state table; only the columns that are used later are read."""
    text = VIEWS[name]
    (table,) = set(re.findall(r"FROM (\w+)", text))
    return spark.sql(re.sub(r"FROM \w+", "FROM {src_}", text), src_=base(spark, sf_dir, table))


def duck(name: str) -> str:
    """The view's text for DuckDB: arrays are lists there, text is VARCHAR."""
    out = VIEWS[name].replace("AS STRING", "AS VARCHAR")
    return re.sub(r"\barray\(", "list_value(", out)


def with_views(sql: str, *names: str) -> str:
    """DuckDB SQL with the named views as common tables in front."""
    heads = ", ".join(f"{n} AS ({duck(n)})" for n in names)
    body = sql.strip()
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            return f"{head}{heads}, {body[len(head):]}"
    return f"WITH {heads} {body}"
