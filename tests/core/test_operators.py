from datetime import datetime

import pytest
from pyspark.sql import functions as F

from listweave.operators import cdc, enrichment, health, policy, publish, quality, search, skills, state, stats, tables

AT = datetime(2024, 6, 1)


def at():
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


# -- tables


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_upsert_is_idempotent(spark):
    old, new = frame(spark, [(1, "a", 5), (2, "b", None)], "k int, v string, n int"), frame(spark, [(2, None, 7), (3, "c", 1)], "k int, v string, n int")
    once = tables.upsert(old, new, ["k"], {"v": "coalesce", "n": "greatest"})
    assert sorted(map(tuple, once.collect())) == [(1, "a", 5), (2, "b", 7), (3, "c", 1)]
    assert sorted(map(tuple, tables.upsert(once, new, ["k"], {"v": "coalesce", "n": "greatest"}).collect())) == sorted(map(tuple, once.collect()))


def test_insert_new_and_delete_missing(spark):
    old = frame(spark, [(1, "a")], "k int, v string")
    table, new = tables.insert_new(old, frame(spark, [(1, "z"), (2, "b"), (2, "b")], "k int, v string"), ["k"])
    assert sorted(map(tuple, table.collect())) == [(1, "a"), (2, "b")] and new.count() == 1
    kept, gone = tables.delete_missing(table, frame(spark, [(2,)], "k int"), ["k"])
    assert [r.k for r in kept.collect()] == [2] and [r.k for r in gone.collect()] == [1]
    assert tables.equal_tables(table, table).count() == 0


# -- change detection

RUN = "id long, source string, phase string, status string, expected_targets array<string>, cdc_status string, cdc_reason string, scope_hash string, coverage_complete boolean, expired_url_count long, reappeared_url_count long, cdc_finished_at timestamp_ntz"
JOB = "id long, source string, url string, listing_status string, last_seen_run_id long, tracking_scope_hash string, expired_at timestamp_ntz, expired_run_id long"


class World:
    """A source whose scans are applied one by one."""

    def __init__(self, spark):
        self.spark, self.jobs, self.runs, self.scopes, self.events = spark, {}, [], [], []

    def scan(self, urls, scope="s", complete=True, targets=("t",), status="running"):
        run = len(self.runs) + 1
        for u in urls:
            row = self.jobs.get(u) or (len(self.jobs) + 1, "src", u, "unknown", None, None, None, None)
            self.jobs[u] = (*row[:4], run, *row[5:])
        self.runs.append((run, "src", "full", status, ["t"], "pending", None, scope, None, None, None, None))
        found = [(run, t, complete, "completed") for t in targets]
        return self.finish(found)

    def finish(self, found):
        s = self.spark
        out = cdc.apply_scans(
            s.createDataFrame(list(self.jobs.values()), JOB), s.createDataFrame(self.runs, RUN),
            s.createDataFrame(found, "run_id long, target_name string, coverage_complete boolean, status string"), s.createDataFrame(self.scopes, "source string, scope_hash string, last_applied_run_id long"), at(),
        )
        events = [(r.event_type, r.job_id) for r in out["events"].collect()]
        self.jobs = {r.url: tuple(r) for r in out["jobs"].collect()}
        self.runs = [tuple(r) for r in out["runs"].orderBy("id").collect()]
        self.scopes = [tuple(r) for r in out["scopes"].collect()]
        return self.runs[-1][5], self.runs[-1][6], sorted(events)

    def status(self, url):
        return self.jobs[url][3]


def test_scans(spark):
    w = World(spark)
    assert w.scan(["a", "b"])[:2] == ("baseline", "initial_or_changed_scope")
    assert w.scan(["b", "c"]) == ("applied", None, [("EXPIRED", 1)]) and [w.status(u) for u in "abc"] == ["expired", "active", "active"]
    assert w.scan(["b", "c"])[2] == []
    assert w.scan(["a", "b", "c"])[2] == [("REAPPEARED", 1)] and w.status("a") == "active"
    assert w.finish([(4, "t", True, "completed")])[2] == []  # finishing again changes nothing
    assert w.scan(["c"], scope="other")[:2] == ("baseline", "initial_or_changed_scope") and [w.status(u) for u in "abc"] == ["unknown", "unknown", "active"]
    assert w.scan(["c"], scope="other")[2] == [] and w.status("a") == "unknown"


@pytest.mark.parametrize("options,reason", [({"complete": False}, "incomplete_coverage"), ({"targets": ()}, "incomplete_targets"), ({"targets": ("t", "u")}, "incomplete_targets"), ({"status": "failed"}, "invalid_run")])
def test_doubtful_scans_are_skipped(spark, options, reason):
    w = World(spark)
    w.scan(["a", "b"])
    assert w.scan(["b"], **options) == ("skipped", reason, []) and w.status("a") == "active"


def test_empty_and_superseded_scans(spark):
    w = World(spark)
    w.scan(["a"])
    assert w.scan([])[:2] == ("skipped", "zero_urls")
    w.runs += [(3, "src", "full", "running", ["t"], "pending", None, "s", None, None, None, None), (4, "src", "full", "running", ["t"], "not_applicable", None, "s", None, None, None, None)]
    w.finish([(3, "t", True, "completed")])
    assert w.runs[2][5:7] == ("skipped", "superseded_run")


def test_scope():
    config = {"source": "s", "discovery": {"targets": [{"name": "b", "q": 1}, {"name": "a", "start_page": 3}, {"name": "c", "enabled": False}]}}
    scope, names = cdc.discovery_scope(config)
    config["discovery"]["targets"].reverse()
    config["discovery"]["targets"][1]["start_page"] = 9
    assert cdc.discovery_scope(config) == (scope, names) and names == ["a", "b"]
    config["discovery"]["targets"][2]["q"] = 2
    assert cdc.discovery_scope(config)[0] != scope
    with pytest.raises(ValueError):
        cdc.discovery_scope({"source": "s", "discovery": {"targets": [{"name": "a"}, {"name": "a"}]}})


# -- policy


def sections(spark, **change):
    v = {"total": 100, "pending": 100, "stuck": 0, "waiting": 100, "hours": 48.0, "phases": ("discovery", "detail", "parse"), "good": 8, "bad": 2} | change
    return {
        "inventory": frame(spark, [("s", v["total"], v["pending"], v["stuck"])] if v["total"] else [], "source string, total_jobs long, pending_fetch long, stuck_fetch long"),
        "raw_and_backlog": frame(spark, [("s", v["waiting"])], "source string, awaiting_usable_parse long"),
        "current_parse_status": frame(spark, [("s", "success", 0)], "source string, status string, stuck_parse long"),
        "freshness": frame(spark, [("s", p, v["hours"]) for p in v["phases"]], "source string, phase string, hours_since_success double"),
        "parse_outcomes_in_window": frame(spark, [("s", "success", v["good"]), ("s", "validation_error", v["bad"])], "source string, status string, jobs long"),
    }


@pytest.mark.parametrize("change,alerts", [
    ({}, []), ({"pending": 101}, ["pending_fetch"]), ({"waiting": 101}, ["parse_backlog"]), ({"stuck": 1}, ["stuck_jobs"]), ({"good": 7, "bad": 3}, ["parse_error_pct"]), ({"good": 4, "bad": 5}, []),
    ({"hours": 49.0}, ["detail_hours_since_success", "discovery_hours_since_success", "parse_hours_since_success"]), ({"phases": ("full",)}, ["parse_hours_since_success"]), ({"total": 0}, ["missing_inventory"]),
])
def test_alerts(spark, change, alerts):
    limits = policy.thresholds(spark, policy.merge_policy({}, ["s"]))
    assert sorted(r.metric for r in policy.evaluate(sections(spark, **change), limits).collect()) == alerts


@pytest.mark.parametrize("bad", [[], {"x": {}}, {"defaults": {"x": 1}}, {"defaults": {"max_stuck_jobs": -1}}, {"defaults": {"max_stuck_jobs": True}}, {"defaults": {"max_stuck_jobs": float("inf")}}, {"defaults": {"min_parse_jobs": None}}, {"defaults": {"min_parse_jobs": 1.5}}, {"defaults": {"max_parse_error_pct": 101}}, {"sources": {"z": {}}}])
def test_policy_fails_closed(bad):
    with pytest.raises(ValueError):
        policy.merge_policy(bad, ["s"])


def test_window_limits():
    with pytest.raises(ValueError):
        health.Window_(AT, window_hours=0)


# -- quality


def record(**change):
    return {"title": "t", "employer_name_raw": "e", "description_text": "d", "requirements_text": "r", "benefits_text": "b", "domains_raw": ["x"], "categories_raw": ["x"], "skills_raw": ["x"], "issues": None} | change


SCHEMA = "title string, employer_name_raw string, description_text string, requirements_text string, benefits_text string, domains_raw array<string>, categories_raw array<string>, skills_raw array<string>, issues array<struct<field:string,severity:string,code:string,message:string>>"


@pytest.mark.parametrize("change,status,score", [
    ({}, "accepted", 100), ({"skills_raw": []}, "partial", 88), ({"title": ""}, "rejected", 88), ({"description_text": None}, "partial", 88), ({"description_text": None, "requirements_text": None}, "rejected", 75),
    ({"issues": [("x", "error", "c", "m")]}, "rejected", 100), ({"issues": [("x", "info", "c", "m")]}, "accepted", 100), ({"title": None, "employer_name_raw": None, "description_text": None, "requirements_text": None, "benefits_text": None, "domains_raw": None, "categories_raw": None}, "rejected", 12),
])
def test_assess(spark, change, status, score):
    r = quality.assess(spark.createDataFrame([record(**change)], SCHEMA)).first()
    assert (r.quality_status, r.completeness_score) == (status, score)


@pytest.mark.parametrize("page,code,want", [
    ("<title>Just a moment...</title>", 200, "Cloudflare challenge"), ("challenges.cloudflare.com", 200, None), ("challenges.cloudflare.com", 403, "Cloudflare challenge"), ("cf-chl-x", 200, None), ("Verify you are human", 200, "CAPTCHA challenge"),
    ("Too many requests", 429, "rate-limit page"), ("x", 403, "HTTP 403 access denied"), ("x" * 200_001 + "rate limit exceeded", 200, "rate-limit page"), (None, None, None),
])
def test_block_reason(spark, page, code, want):
    assert spark.createDataFrame([(page, code)], "h string, c int").select(quality.block_reason("h", "c")).first()[0] == want


# -- search

LISTING = "id long, source_id long, source_code string, source_name string, title string, skills_raw array<string>, employer_name_raw string, categories_raw array<string>, location_cities array<string>, posted_at timestamp_ntz, first_seen_at timestamp_ntz, enrichment_status string, experience_min_years double, experience_max_years double, seniority_levels array<string>, work_mode string, skills_required array<string>, skills_preferred array<string>"


def listing(i, title, employer=None, posted=None, source="one", **more):
    d = {"id": i, "source_id": 1, "source_code": source, "source_name": source.title(), "title": title, "skills_raw": [], "employer_name_raw": employer, "categories_raw": [], "location_cities": ["Hà Nội"], "posted_at": posted, "first_seen_at": datetime(2024, 5, 31), "enrichment_status": None, "experience_min_years": None, "experience_max_years": None, "seniority_levels": None, "work_mode": None, "skills_required": None, "skills_preferred": None}
    return d | more


@pytest.fixture(scope="module")
def small(spark):
    day = lambda n: datetime(2024, 5, n)
    rows = [listing(101, "Data Engineer", None, day(20)), listing(102, "Data Engineering", None, day(19)), listing(103, "Database Engineer", None, None, "two"), listing(104, "Other role", "Data Engineer", day(21)), listing(105, "Data Engineer", None, day(20), "two"), listing(106, "Full-stack Developer"), listing(107, "Data Engineer")]
    return search.with_lexemes(skills.with_skill_keys(spark.createDataFrame(rows, LISTING))).cache()


@pytest.mark.parametrize("text,want", [
    ("data eng", [105, 101, 102, 107, 104]), ("data enginee", [105, 101, 102, 107, 104]), ("data engineer", [105, 101, 102, 107, 104]), ("data eng  ", [105, 101, 102, 107, 104]), ("data en", []), ("data e", []), ("dat enginee", []), ("ngineer", []), ("...", []),
    ("full-stack dev", [106]), ("full-sta", [106]), ('"data engineer" -other', [105, 101, 107]),
])
def test_prefix_search(small, text, want):
    assert [r.id for r in search.search_simple(small, text).collect()] == want


def test_search_sets_and_paging(small):
    ids = lambda **k: {r.id for r in search.search_simple(small, **k).collect()}
    assert ids(query="enginee") == {101, 102, 103, 104, 105, 107} and ids(query="data eng", source="two", city="Hà Nội") == {105} and ids(query="database or developer") == {103, 106}
    assert ids(query="data eng", prefix=False) == set() and ids() == {101, 102, 103, 104, 105, 106, 107}
    whole = [r.id for r in search.search_simple(small, "enginee").collect()]
    assert [r.id for n in range(0, 6, 2) for r in search.search_simple(small, "enginee", limit=2, offset=n).collect()] == whole


def test_rank_values(spark):
    rows = [listing(1, "data"), listing(2, "data data"), listing(3, "data engineer"), listing(4, "x", "data")]
    jobs = search.with_lexemes(spark.createDataFrame(rows, LISTING))
    score = lambda q: {r.id: round(r.s, 6) for r in jobs.select("id", search.rank(search.parse_query(q, False)[1]).alias("s")).collect()}
    assert score("data") == {1: 0.607927, 2: 0.759909, 3: 0.607927, 4: 0.243171}
    assert score("data engineer")[3] == pytest.approx(0.991032, abs=2e-5)


@pytest.fixture(scope="module")
def many(spark):
    rows = []
    for n in range(1, 46):
        more = {"location_cities": ["Hà Nội", "Đà Nẵng"] if n % 2 == 0 else ["Hồ Chí Minh"], "enrichment_status": "succeeded", "experience_min_years": 2.0, "experience_max_years": 4.0, "seniority_levels": ["junior", "middle"], "work_mode": "remote", "skills_required": ["Python", "Postgres", "PostgreSQL"], "skills_preferred": ["SQL", "Postgres"]}
        more |= {1: {"experience_min_years": 0.0}, 2: {"experience_min_years": None, "skills_required": None, "skills_preferred": ["SQL"]}, 3: {"enrichment_status": "not_enriched"}, 4: {"first_seen_at": None}, 5: {"posted_at": datetime(2024, 4, 20)}}.get(n, {})
        rows.append(listing(n, "Data Engineer C++", **({"first_seen_at": datetime(2024, 5, 31, 22)} | more)))
    return search.with_lexemes(skills.with_skill_keys(spark.createDataFrame(rows, LISTING))).cache()


@pytest.mark.parametrize("filters,n", [
    ({"experience": "zero"}, 1), ({"experience": "unknown"}, 2), ({"seniority": ["junior", "middle"]}, 44), ({"modes": ["unknown"]}, 1), ({"modes": ["remote", "unknown"]}, 45), ({"days": 1}, 43), ({"skills": ["python"]}, 43),
    ({"skills": ["python", "sql"], "skill_match": "all"}, 0), ({"skills": ["python", "sql"], "skill_match": "all", "skill_scope": "all"}, 43), ({"skills": ["sql"], "skill_scope": "all"}, 44), ({"cities": ["Đà Nẵng"]}, 22), ({"sources": ["none"]}, 0), ({"query": "c++"}, 45),
])
def test_filters_and_totals_agree(many, filters, n):
    f = search.Filters(**filters)
    assert search.matching(many, f, AT)[0].count() == n
    assert stats.statistics(many, f, AT)["coverage"].first().total == n


def test_statistics(many):
    s = stats.statistics(many, search.Filters(), AT)
    c = s["coverage"].first()
    assert (c.total, c.normalized) == (45, 43)
    rows = {(r.kind, r.key): r["count"] for r in s["rows"].collect()}
    assert rows["skill", "postgresql"] == 43 and rows["city", "Hà Nội"] == 22 and rows["mode", "unknown"] == 1 and rows["experience", "zero"] == 1
    assert '"total":45' in stats.statistics_json(many, search.Filters(), AT).first()[0]


@pytest.mark.parametrize("bad", [{"query": "x" * 201}, {"days": 2}, {"experience": "x"}, {"modes": ["x"]}, {"sources": ["A B"]}, {"cities": [""]}, {"cities": ["a\n"]}, {"seniority": ["x"]}, {"skills": None}, {"skill_match": "some"}, {"sources": ["a"] * 21}, {"skills": ["x"], "known_skills": frozenset("y")}])
def test_bad_filters(bad):
    with pytest.raises(search.InvalidFilter):
        search.Filters(**bad)


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 101}, {"offset": -1}, {"offset": 10_001}, {"sort": "x"}])
def test_bad_pages(bad):
    with pytest.raises(search.InvalidFilter):
        search.Page(**bad)


def test_skills(spark):
    a = lambda *v: F.array(*[F.lit(x) for x in v])
    req, pref = a("Postgres", "PostgreSQL", "C++", "C#", "C", "Java"), a("JS", "Postgres", "React Native", "ReactJS", "vague skill")
    r = spark.range(1).select(skills.normalize_skills(req), skills.preferred_skills(req, pref), skills.unknown_skills(pref)).first()
    assert r[0] == ["c", "cplusplus", "csharp", "java", "postgresql"] and r[1] == ["javascript", "react", "react-native"] and r[2] == ["vague skill"]
    with pytest.raises(ValueError):
        skills.spellings([{"key": "a", "label": "X", "aliases": []}, {"key": "b", "label": "x", "aliases": []}])


# -- enrichment


def test_packing():
    p = enrichment.Packing(size=3, ratio=1.0, output_per_job=0, max_input_tokens=100)
    assert enrichment.pack([(1, 40, 0), (2, 40, 0), (3, 40, 0), (4, 10, 1), (5, 10, 0)], p) == [[1, 2], [3, 5], [4]]
    assert enrichment.pack([(1, 10, 1), (2, 10, 0)], p) == [[1], [2]] and enrichment.pack([], p) == []


def result(**change):
    quotes = {f: [] for f in enrichment.RESULT_FIELDS} | {"skills_required": ["Yêu cầu  Python."]}
    quotes |= change.pop("evidence", {})
    return {f: None for f in enrichment.RESULT_FIELDS} | {"skills_required": ["Python"]} | change | {"evidence": quotes}


@pytest.mark.parametrize("change,code", [
    ({}, None), ({"work_mode": "remote"}, "missing_evidence"), ({"evidence": {"work_mode": ["Python"]}}, "evidence_for_null"), ({"evidence": {"skills_required": ["invented"]}}, "unsupported_evidence"), ({"evidence": {"skills_required": [" "]}}, "invalid_quote"),
    ({"skills_required": []}, "invalid_array"), ({"skills_required": ["Python", "python "]}, "duplicate_values"), ({"skills_required": ["x" * 121]}, "invalid_array_item"), ({"seniority_levels": ["guru"], "evidence": {"seniority_levels": ["Python"]}}, "invalid_enum"),
    ({"experience_min_years": 61.0, "evidence": {"experience_min_years": ["Python"]}}, "invalid_experience"), ({"skills_preferred": ["PYTHON"], "evidence": {"skills_preferred": ["Python"]}}, "conflicting_skills"),
    ({"experience_min_years": 5.0, "experience_max_years": 2.0, "evidence": {"experience_min_years": ["Python"], "experience_max_years": ["Python"]}}, "reversed_experience"),
])
def test_validation(spark, change, code):
    row = spark.createDataFrame([result(**change)], enrichment.RESULT_SCHEMA)
    assert row.select(enrichment.validation_error(F.array(F.lit("Yêu cầu Python. Ưu tiên SQL.")))).first()[0] == code


def test_batches_match_by_id(spark):
    expected = frame(spark, [(1, 1), (1, 2), (2, 3), (3, 4)], "request int, job_id int")
    got = enrichment.batch_outcomes(expected, frame(spark, [(1, 1), (1, 1), (2, 3), (2, 9), (3, 4)], "request int, job_id int"))
    assert {(r.request, r.job_id): r.error for r in got.collect()} == {(1, 1): "duplicate_batch_job", (1, 2): "missing_batch_job", (2, 3): "unknown_batch_job", (3, 4): None}


def test_backfill_window():
    b = enrichment.Backfill(as_of="2024-06-01T00:00:00", lookback_days=2).resolved()
    assert b.date_from.startswith("2024-05-30") and b.date_to == b.as_of
    for bad in ({"lookback_days": 0}, {"max_jobs": 1001}, {"date_field": "x"}, {"date_from": "2024-07-01", "as_of": "2024-06-01"}, {"posting_ids": (0,)}):
        with pytest.raises(ValueError):
            enrichment.Backfill(**bad).resolved()


# -- state and publishing


def test_content_checks(spark):
    import hashlib

    good, bad = b"ok", b"\xff"
    h = lambda b: hashlib.sha256(b).hexdigest()
    rows = [(1, good, 2, h(good)), (2, good, 3, h(good)), (3, good, 2, "x"), (4, bad, 1, h(bad)), (5, None, 1, "x")]
    got = state.check_content(frame(spark, [(i, None if c is None else bytearray(c), n, s) for i, c, n, s in rows], "id int, content binary, content_length_bytes long, content_sha256 string"))
    assert {r.id: r.integrity_error for r in got.collect()} == {1: None, 2: "size_mismatch", 3: "hash_mismatch", 4: "not_utf8", 5: "raw_missing"}


def test_budget_passes_over_what_does_not_fit(spark):
    rows = [("s", i, n, datetime(2024, 1, i)) for i, n in ((1, 50), (2, 80), (3, 40), (4, 5), (5, 5))]
    got = state.within_budget(frame(spark, rows, "source string, raw_object_id long, content_length_bytes long, stored_at timestamp_ntz"), 3, 100)
    assert {r.raw_object_id for r in got.where("selected").collect()} == {1, 3, 4}


def test_reconcile(spark):
    schema = "id long, source_id long, canonical_url string, title string, last_seen_at timestamp_ntz"
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 2, 1)
    staged = frame(spark, [(1, 1, "a", "new", t1), (2, 1, "b", "same", t1)], schema)
    serving = frame(spark, [(2, 1, "b", "same", t1, t0), (3, 1, "c", "kept", t0, t0), (4, 1, "d", "gone", t0, t0)], schema + ", updated_at timestamp_ntz")
    active = frame(spark, [(1, "active", t1), (2, "active", t1), (3, "active", t1), (4, "expired", t1)], "id long, listing_status string, last_seen_at timestamp_ntz")
    columns = ("id", "source_id", "canonical_url", "title", "last_seen_at")
    count = lambda table: {r.change: r.n for r in publish.changes(table, staged, active, columns).collect()}
    assert count(serving) == {"inserts": 1, "updates": 0, "deletes": 1, "refresh_retained": 1, "active_without_content": 1}
    out = publish.reconcile(serving, staged, active, at())
    got = {r.id: (r.title, r.last_seen_at, r.updated_at) for r in out.collect()}
    assert got == {1: ("new", t1, AT), 2: ("same", t1, t0), 3: ("kept", t1, AT)}
    assert count(out) == {"inserts": 0, "updates": 0, "deletes": 0, "refresh_retained": 0, "active_without_content": 1}
    with pytest.raises(publish.PublishRefused):
        publish.enforce({"x": serving})
    publish.enforce({"x": serving.where("id < 0")})
