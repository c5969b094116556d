"""Queries over checks of answers and objects, built pages, headings, logs and conditional changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.functions import html as H
from listweave.functions import text as T
from listweave.operators import audit, cdc, enrichment, quality, search, state, stats, tables
from listweave.plans.adapters import AS_OF, TS, base, view
from listweave.plans.register import QUERIES, at, query
from listweave.plans.serving_queries import _listings as listings
from listweave.sources import sites

# -- answers of the model ----------------------------------------------------------------------------


@query("enrich_batch_outcomes", """
  WITH asked AS (SELECT user_id AS request, event_id AS job_id FROM events),
  told AS (SELECT request, job_id, 1 + CAST(job_id % 11 = 0 AS INT) AS n FROM asked WHERE job_id % 7 > 0),
  odd AS (SELECT DISTINCT request FROM asked WHERE job_id % 997 = 0)
  SELECT request, job_id, CASE WHEN request IN (SELECT request FROM odd) THEN 'unknown_batch_job' WHEN n IS NULL THEN 'missing_batch_job' WHEN n > 1 THEN 'duplicate_batch_job' END AS error
  FROM asked LEFT JOIN told USING (request, job_id)""")
def _(s, d):
    asked = base(s, d, "events").select(F.col("user_id").alias("request"), F.col("event_id").alias("job_id"))
    # an answer that does not come, or comes once only, is one to no request
    told = lambda where, job: asked.select(F.when(F.expr(where), F.col("request")).alias("request"), F.expr(job).alias("job_id"))
    answers = told("job_id % 7 > 0", "job_id").unionByName(told("job_id % 7 > 0 and job_id % 11 = 0", "job_id")).unionByName(told("job_id % 997 = 0", "-job_id - 1"))
    return enrichment.batch_outcomes(asked, answers)


_FLAT = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_LONG, _SHORT = "substr(text, 4, 30)", "substr(text, 1, 12)"


def _bad(q: str) -> str:
    return f"coalesce(trim({q}), '') = ''"


def _strange(q: str) -> str:
    return f"NOT contains({_FLAT.format('text')}, {_FLAT.format(q)})"


@query("enrich_validation", f"""
  SELECT doc_id, CASE
    WHEN doc_id % 7 > 1 AND {_bad(_LONG)} THEN 'invalid_quote'
    WHEN doc_id % 7 = 1 AND NOT coalesce(contains(text, 'no such quote'), false) OR doc_id % 7 > 1 AND {_strange(_LONG)} THEN 'unsupported_evidence'
    WHEN doc_id % 5 = 1 AND doc_id % 7 > 0 THEN 'evidence_for_null' WHEN doc_id % 5 <> 1 AND doc_id % 7 = 0 THEN 'missing_evidence' WHEN doc_id % 5 = 0 THEN 'duplicate_values'
    WHEN (doc_id % 3 = 0 OR doc_id % 2 = 0) AND {_bad(_SHORT)} THEN 'invalid_quote'
    WHEN (doc_id % 3 = 0 OR doc_id % 2 = 0) AND {_strange(_SHORT)} THEN 'unsupported_evidence'
    WHEN doc_id % 2 = 0 AND doc_id % 64 > 60 THEN 'invalid_experience'
    WHEN (doc_id % 11 < 5 OR doc_id % 13 < 2) AND {_bad(_SHORT)} THEN 'invalid_quote'
    WHEN (doc_id % 11 < 5 OR doc_id % 13 < 2) AND {_strange(_SHORT)} THEN 'unsupported_evidence'
    WHEN doc_id % 13 = 0 THEN 'invalid_enum'
    WHEN doc_id % 2 = 0 AND doc_id % 11 < 5 AND doc_id % 64 > doc_id % 17 THEN 'reversed_experience'
    WHEN doc_id % 5 > 1 AND doc_id % 3 = 0 THEN 'conflicting_skills' END AS error FROM documents""")
def _(s, d):
    none = F.array().cast("array<string>")
    k, short = F.col("doc_id"), F.array(F.substring("text", 1, 12))
    values = {
        "skills_required": F.when(k % 5 == 0, F.array(F.lit("Python"), F.lit("python"))).when(k % 5 > 1, F.array(F.lit("Python"), F.lit("Go"))),
        "skills_preferred": F.when(k % 3 == 0, F.array(F.lit("go"))),
        "experience_min_years": F.when(k % 2 == 0, (k % 64).cast("double")),
        "experience_max_years": F.when(k % 11 < 5, (k % 17).cast("double")),
        "seniority_levels": F.lit(None).cast("array<string>"),
        "work_mode": F.when(k % 13 == 0, "moon").when(k % 13 == 1, "remote"),
        "employment_type": F.lit(None).cast("string"),
    }
    quotes = {f: F.when(v.isNotNull(), short).otherwise(none) for f, v in values.items()}
    quotes["skills_required"] = F.when(k % 7 == 0, none).when(k % 7 == 1, F.array(F.lit("no such quote"))).otherwise(F.array(F.substring("text", 4, 30)))
    docs = base(s, d, "documents").select("doc_id", "text", *[v.alias(f) for f, v in values.items()], F.struct(*[v.alias(f) for f, v in quotes.items()]).alias("evidence"))
    return docs.select("doc_id", enrichment.validation_error(F.array("text")).alias("error"))


# -- raw objects, scopes and logs ----------------------------------------------------------------------


@query("state_content_errors", """SELECT page_id, CASE WHEN page_id % 11 = 0 OR html IS NULL THEN 'raw_missing' WHEN page_id % 5 = 0 THEN 'size_mismatch' WHEN page_id % 7 = 0 THEN 'hash_mismatch' WHEN page_id % 13 = 0 THEN 'not_utf8' END AS integrity_error FROM pages""")
def _(s, d):
    k, page = F.col("page_id"), F.encode("html", "UTF-8")
    content = F.when(k % 13 == 0, F.concat(page, F.unhex(F.lit("FF")))).otherwise(page)
    p = base(s, d, "pages").select("page_id", F.when(k % 11 > 0, content).alias("content"), (F.octet_length(content) + F.when(k % 5 == 0, 1).otherwise(0)).cast("long").alias("content_length_bytes"), F.when(k % 7 > 0, F.sha2(content, 256)).otherwise(F.lit("0")).alias("content_sha256"))
    return state.check_content(p).select("page_id", "integrity_error")


@query("table_upsert_where", """
  WITH old AS (SELECT object_key, content_sha256, purged_at FROM raw_objects), new AS (SELECT CASE WHEN job_id % 10 = 0 OR job_id % 3 = 0 THEN 'new-' || object_key ELSE object_key END AS object_key, CASE WHEN job_id % 2 = 0 THEN md5(object_key) ELSE content_sha256 END AS content_sha256 FROM raw_objects)
  SELECT coalesce(o.object_key, n.object_key) AS object_key, CASE WHEN n.object_key IS NULL OR (o.object_key IS NOT NULL AND purged_at IS NULL AND n.content_sha256 = o.content_sha256) THEN o.content_sha256 ELSE n.content_sha256 END AS content_sha256,
    CASE WHEN n.object_key IS NULL THEN o.purged_at END AS purged_at, NOT (n.object_key IS NULL OR (o.object_key IS NOT NULL AND purged_at IS NULL AND n.content_sha256 = o.content_sha256)) AS touched
  FROM old o FULL JOIN new n ON o.object_key = n.object_key""", ("raw_objects",))
def _(s, d):
    raw, k = view(s, d, "raw_objects"), F.col("job_id")
    old = raw.select("object_key", "content_sha256", "purged_at", F.lit(False).alias("touched"))
    key = F.when((k % 10 == 0) | (k % 3 == 0), F.concat(F.lit("new-"), "object_key")).otherwise(F.col("object_key"))
    sha = F.when(k % 2 == 0, F.md5(F.col("object_key").cast("binary"))).otherwise(F.col("content_sha256"))
    new = raw.select(key.alias("object_key"), sha.alias("content_sha256"), F.lit(None).cast(raw.schema["purged_at"].dataType).alias("purged_at"), F.lit(True).alias("touched"))
    return tables.upsert_where(old, new, ["object_key"], F.col("purged_at").isNotNull() | (F.col("new_content_sha256") != F.col("content_sha256")))


_TARGETS = '[{"keyword":"Hà Nội","name":"a"},{"name":"b","url":"https://site.example/b"}]'


@query("cdc_scope_hashes", f"""SELECT code AS source, sha256('{{"adapter":"pages","scope_version":2,"source":"' || code || '","targets":{_TARGETS}}}') AS scope_hash, 'a,b' AS targets FROM src""", ("src",))
def _(s, d):
    targets = [{"name": "b", "url": "https://site.example/b", "start_page": 3, "enabled": True}, {"name": "off", "enabled": False}, {"name": "a", "keyword": "Hà Nội", "total_pages": 9}]
    found = [(c, *cdc.discovery_scope({"source": c, "source_adapter": "pages", "cdc": {"scope_version": 2}, "discovery": {"targets": targets}})) for c in (f"src{i}" for i in range(9))]
    scopes = s.createDataFrame([(c, h, ",".join(names)) for c, h, names in found], "code string, scope_hash string, targets string")
    return view(s, d, "src").join(F.broadcast(scopes), "code").select(F.col("code").alias("source"), "scope_hash", "targets")


@query("audit_old_logs", f"""SELECT o_custkey AS run_id, count(*) AS files, CAST(sum(floor(o_totalprice)) AS BIGINT) AS bytes, max(o_orderdate) AS newest FROM orders GROUP BY 1 HAVING max(o_orderdate) < {TS} - INTERVAL '900' DAY""")
def _(s, d):
    files = base(s, d, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").cast("string").alias("path"), F.floor("o_totalprice").alias("length"), F.col("o_orderdate").cast("timestamp_ntz").alias("modificationTime"))
    return audit.old_logs(files, at(), 900)


# -- headings ------------------------------------------------------------------------------------------


@query("text_cut_at_heading", r"""SELECT doc_id, sha256(nullif(regexp_replace(CASE doc_id % 3 WHEN 2 THEN text || chr(10) || 'Requirements are these' ELSE text END, '^\s+|\s+$', '', 'g'), '')) AS kept_sha256 FROM documents""")
def _(s, d):
    k = F.col("doc_id")
    after = F.when(k % 3 == 0, "\n  REQUIREMENTS : \nmore").when(k % 3 == 1, "\nwhat we offer\n\nmore\nbenefits").otherwise("\nRequirements are these")
    kept = T.cut_at_heading(F.concat("text", after), ["Requirements", "What we offer", "Benefits"])
    return base(s, d, "documents").select("doc_id", F.sha2(kept, 256).alias("kept_sha256"))


@query("text_without_heading", r"""
  WITH h AS (SELECT doc_id, CASE doc_id % 2 WHEN 0 THEN 'Job Description' ELSE 'Job Description here' END AS head, text FROM documents),
  l AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(head || chr(10) || text, '\r\n|[\n\r]'), lambda s: regexp_replace(trim(regexp_replace(s, '[\t ]+', ' ', 'g')), '\s+([,.;:!?%])', '\1', 'g')), lambda s: s <> '') AS x FROM h),
  u AS (SELECT doc_id, list_filter(x, lambda s, i: i = 1 OR s <> x[i - 1]) AS x FROM l)
  SELECT doc_id, sha256(nullif(array_to_string(CASE doc_id % 2 WHEN 0 THEN x[2:] ELSE x END, chr(10)), '')) AS kept_sha256 FROM u""")
def _(s, d):
    head = F.when(F.col("doc_id") % 2 == 0, "  JOB \t description \n").otherwise("Job Description here\n")
    return base(s, d, "documents").select("doc_id", F.sha2(T.without_heading(F.concat(head, "text"), "Job Description"), 256).alias("kept_sha256"))


# -- built pages ---------------------------------------------------------------------------------------

_BUILT = """concat('<div><h2>', c_mktsegment, '</h2><p>', c_name, ' &amp; <b>Co</b> , Ltd</p><script>var x = 1;</script><style>p {}</style><ul><li>', c_custkey, '</li><li> A  b </li><li>a<br>B</li></ul><h2>Next</h2>tail</div>')"""


@query("html_blocks", """SELECT c_custkey, c_mktsegment || chr(10) || c_name || ' & Co, Ltd' || chr(10) || c_custkey || chr(10) || 'A b' || chr(10) || 'a' || chr(10) || 'B' || chr(10) || 'Next' || chr(10) || 'tail' AS text,
  c_custkey || '|A b|a' || chr(10) || 'B' AS items, c_mktsegment || ' ' || c_name || ' & Co , Ltd ' || c_custkey || ' A b a B Next tail' AS visible, c_name || ' & Co, Ltd' || chr(10) || c_custkey || chr(10) || 'A b' || chr(10) || 'a' || chr(10) || 'B' AS section, 'tail' AS last FROM customer""")
def _(s, d):
    page = F.expr(_BUILT)
    sections = H.html_sections(page)
    return base(s, d, "customer").select("c_custkey", H.html_text(page).alias("text"), F.array_join(H.html_items(page), "|").alias("items"), H.visible_text(page).alias("visible"), F.element_at(sections, F.col("c_mktsegment")).alias("section"), F.element_at(sections, F.lit("Next")).alias("last"))


_WORDS = "repeat('word ', CAST(c_custkey % 60 AS INT))"


@query("quality_accept_built", f"""
  WITH p AS (SELECT c_custkey AS id, '<html><body><article>' || CASE WHEN c_custkey % 7 > 0 THEN '<h1>' || c_name || '</h1>' ELSE '<h2>' || c_name || '</h2>' END || '<p>' || {_WORDS} || '</p></article></body></html>' AS html, trim(c_name || ' ' || {_WORDS}) AS shown FROM customer)
  SELECT id, array_to_string(list_filter([CASE WHEN id % 11 = 0 THEN 'unexpected_http_status' END, CASE WHEN id % 8 = 0 THEN 'unexpected_content_type' END, CASE WHEN strlen(html) < 200 THEN 'html_too_small' END, CASE WHEN id % 5 = 0 THEN 'unexpected_final_host' END,
    CASE WHEN id % 9 = 0 THEN 'unexpected_final_path' END, CASE WHEN length(shown) < 100 THEN 'visible_text_too_short' END, CASE WHEN id % 7 = 0 THEN 'missing_required_selector:article h1' END], lambda e: e IS NOT NULL), ',') AS errors,
    'missing_optional_selector:aside' AS warnings, CAST(strlen(html) AS INT) AS html_bytes, CAST(length(shown) AS INT) AS visible_text_chars FROM p""")
def _(s, d):
    k = F.col("c_custkey")
    head = F.when(k % 7 > 0, F.concat(F.lit("<h1>"), "c_name", F.lit("</h1>"))).otherwise(F.concat(F.lit("<h2>"), "c_name", F.lit("</h2>")))
    p = base(s, d, "customer").select(
        k.alias("id"), F.concat(F.lit("<html><body><article>"), head, F.lit("<p>"), F.expr(_WORDS), F.lit("</p></article></body></html>")).alias("html"), F.lit("https://site.example/job/1").alias("url"),
        F.concat(F.when(k % 5 == 0, "https://other.example/").otherwise("https://Site.example/"), F.when(k % 9 == 0, "login").otherwise("job/1")).alias("final_url"),
        F.when(k % 11 == 0, 500).otherwise(200).alias("http_status"), F.when(k % 8 == 0, "application/json").when(k % 8 == 1, F.lit(None)).otherwise("Text/HTML; charset=utf-8").alias("content_type"),
    )
    rules = quality.Acceptance(min_bytes=200, min_text_chars=100, path_prefixes=("/job/",), required_selectors=("article h1",), optional_selectors=("article p", "aside"))
    return quality.accept_pages(p, rules).select("id", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), F.col("metrics.html_bytes").alias("html_bytes"), F.col("metrics.visible_text_chars").alias("visible_text_chars"))


def _with_posting(s, d, posting: dict[str, str]) -> DataFrame:
    """Pages of two sites behind a JSON-LD graph of a page and a posting; ``posting`` holds SQL by key."""
    p = base(s, d, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, "topdev").otherwise("vietnamworks").alias("source"), F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("url"), "html")
    ld = F.to_json(F.struct(F.array(F.to_json(F.struct(F.lit("WebPage").alias("@type"))), F.to_json(F.struct(F.array(F.lit("Thing"), F.lit("JobPosting")).alias("@type"), *[F.expr(v).alias(k) for k, v in posting.items()]))).alias("g")))
    graph = F.concat(F.lit('{"@graph":['), F.concat_ws(",", F.from_json(ld, "g array<string>")["g"]), F.lit("]}"))
    return p.withColumn("html", F.concat(F.lit('<script type="application/ld+json">{bad</script><script type="application/ld+json">'), graph, F.lit("</script>"), "html"))


@query("extract_posting_fields", """SELECT url || '#' || page_id AS url, 'N' || page_id AS external_id, page_id || ' Main, Huế, VN|Da Nang' AS locations, 'FULL_TIME' AS employment_type, '2001-07-0' || (page_id % 9 + 1) AS posted_at, 'Engineer ' || page_id AS title, 'public_html_json_ld' AS variant FROM pages""")
def _(s, d):
    place = "named_struct('streetAddress', concat(page_id, ' Main'), 'addressLocality', 'Huế', 'addressRegion', 'HUẾ', 'addressCountry', named_struct('name', 'VN'))"
    pages = _with_posting(s, d, {
        "title": "concat(' Engineer  ', page_id)", "description": "'Build'", "identifier": "named_struct('name', 'x', 'value', concat('N', page_id))", "employmentType": "'FULL_TIME'", "datePosted": "concat('2001-07-0', page_id % 9 + 1)",
        "jobLocation": f"array(named_struct('address', {place}), named_struct('address', named_struct('streetAddress', 'Da Nang', 'addressLocality', string(null), 'addressRegion', 'da nang', 'addressCountry', named_struct('name', string(null)))))",
    })
    return sites.extract(pages).select("url", F.col("source_external_job_id").alias("external_id"), F.array_join("locations_raw", "|").alias("locations"), F.col("employment_type_raw").alias("employment_type"), "posted_at", "title", F.col("source_variant").alias("variant"))


@query("extract_hydration", """SELECT url || '#' || page_id AS url, CASE WHEN page_id % 4 > 0 THEN 'Engineer ' || page_id END AS title, CASE WHEN page_id % 4 > 0 THEN 'Acme' END AS employer, CASE WHEN page_id % 4 > 0 THEN 'Build' || chr(10) || 'Run' END AS description,
  CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 2 = 0 THEN 'IT|Sales' ELSE 'Sales' END AS categories, CASE WHEN page_id % 4 = 0 THEN '' ELSE '1 Main, Huế' END AS locations, CASE WHEN page_id % 4 > 0 THEN CAST(page_id AS VARCHAR) END AS external_id FROM pages""")
def _(s, d):
    job = "named_struct('id', page_id, 'title', concat('Engineer ', page_id), 'employer_info', named_struct('name', 'Acme'), 'description_html', '<p>Build</p><p>Run</p>', 'occupation_ids_main', if(page_id % 2 = 0, array(1, 2), array(2)), 'places', array(named_struct('address', '1 Main', 'province_id', 7)))"
    common = "named_struct('occupation', array(named_struct('id', 1, 'name', 'IT'), named_struct('id', 2, 'name', 'Sales')), 'provinces', array(named_struct('id', 7, 'name', 'Huế')))"
    api = f"named_struct('jobDetailHiddenContact', named_struct('code', if(page_id % 4 > 0, 200, 500), 'data', {job}), 'initCommon', named_struct('code', 200, 'data', {common}))"
    text = F.expr(f"to_json(named_struct('props', named_struct('initialState', named_struct('api', {api}))))")
    p = base(s, d, "pages").select(F.lit("vieclam24h").alias("source"), F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("url"), F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), text, F.lit("</script>"), "html").alias("html"))
    return sites.extract(p).select("url", "title", F.col("employer_name_raw").alias("employer"), F.col("description_text").alias("description"), F.array_join("categories_raw", "|").alias("categories"), F.array_join("locations_raw", "|").alias("locations"), F.col("source_external_job_id").alias("external_id"))


_BARS = {
    "careerlink": """concat('<ul class="pagination"><a href="?page=1">1</a><a href="?q=x&page=', n, '">n</a></ul>')""",
    "topcv": "concat('<span>1 / ', n, ' trang</span>')",
    "topdev": "concat('<button>1</button><button aria-label=\"Go to page ', n, '\">x</button>')",
    "devwork": "concat('<script>window.__NUXT__={total_pages: ', n, '}</script>')",
    "careerviet": "concat('<script>self.push(\"{\\\\\"totalJobs\\\\\": ', n * 20 - 3, ', \\\\\"limit\\\\\": 20}\")</script>')",
    "vieclam24h": """concat('<script id="__NEXT_DATA__">{"props":{"initialState":{"api":{"list":{"data":{"total_pages":', n, '}}}}}}</script>')""",
    "jobsgo": "concat('<h1>', format_number(n * 50 - 7, 0), ' việc làm</h1>')",
}


@query("extract_last_pages_by_site", f"SELECT source, page_id % 40 + 2 AS last_page, count(*) AS n FROM pages, (SELECT unnest({list(_BARS)}) AS source) GROUP BY ALL")
def _(s, d):
    bars = F.array(*[F.struct(F.lit(k).alias("source"), F.expr(v).alias("html")) for k, v in _BARS.items()])
    p = base(s, d, "pages").select("url", (F.col("page_id") % 40 + 2).alias("n")).select("url", F.explode(bars).alias("x")).select("x.source", "url", "x.html")
    return sites.last_pages(p).groupBy("source", F.col("last_page").cast("long").alias("last_page")).agg(F.count("*").alias("n"))


@query("extract_listing_ids", """SELECT 'careerlink' AS source, 0 AS position, 'https://www.careerlink.vn/tim-viec-lam/first/' || page_id AS job_url FROM pages UNION ALL SELECT 'careerlink', 1, 'https://www.careerlink.vn/tim-viec-lam/third/' || (page_id + 1) FROM pages
  UNION ALL SELECT 'jobsgo', 0, 'https://jobsgo.vn/viec-lam/first-' || page_id || '.html' FROM pages""")
def _(s, d):
    link = lambda path, n: f"concat('<li class=\"job-item\"><a class=\"job-link\" href=\"/tim-viec-lam/{path}/', {n}, '/?src=x\">a</a></li>')"
    one = F.concat(F.expr(link("first", "page_id")), F.expr(link("second", "page_id")), F.expr(link("third", "page_id + 1")), F.lit('<li class="job-item"><a class="job-link" href="https://else.example/tim-viec-lam/x/1">b</a></li>'))
    two = F.expr("""concat('<div class="job-list"><p class="job-title"><a href="/viec-lam/first-', page_id, '.html">a</a><a href="/viec-lam/second-', page_id, '.html#x">a</a><a href="/about">b</a></p></div>')""")
    shown = F.array(F.struct(F.lit("careerlink").alias("source"), F.lit("https://www.careerlink.vn/list").alias("url"), one.alias("html")), F.struct(F.lit("jobsgo").alias("source"), F.lit("https://jobsgo.vn/list").alias("url"), two.alias("html")))
    p = base(s, d, "pages").select(F.explode(shown).alias("x")).select("x.*")
    return sites.discover(p).select("source", "position", "job_url")


# -- statistics and streams' batch forms -----------------------------------------------------------------

_FACETS = QUERIES["stats_facets"][1]


@query("stats_json_rows", f"SELECT f.kind, f.key, f.label, f.count, (SELECT count(*) FROM documents) AS total FROM ({_FACETS}) f")
def _(s, d):
    row = stats.statistics_json(listings(s, d), search.Filters(skill_scope="all"), AS_OF)
    whole = F.from_json("statistics", "total long, rows array<struct<kind:string,key:string,label:string,count:int>>")
    return row.select(whole.alias("w")).select("w.total", F.explode("w.rows").alias("r")).select("r.*", "total")
