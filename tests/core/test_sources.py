import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from listweave.operators import policy
from listweave.sources import configs, raw, reports, sites
from listweave.sources.store import TableStore
from listweave.streaming import streams

LD = '<script type="application/ld+json">' + json.dumps({
    "@type": "JobPosting", "title": "Engineer", "description": "<p>Build</p><p>Run</p>", "hiringOrganization": {"name": "Acme"}, "industry": "IT, Software", "skills": "Python, SQL", "datePosted": "2024-01-02",
    "jobLocation": {"address": {"addressLocality": "Hà Nội"}}, "identifier": {"value": "J1"}, "jobBenefits": "<ul><li>Bonus</li><li>Lunch</li></ul>", "experienceRequirements": "2 years",
}) + "</script>"


def of(source, page, url="https://x/y"):
    return sites.extract_record(sites.SITES[source], page, url)


def test_nine_sites():
    assert sorted(sites.SITES) == ["careerlink", "careerviet", "devwork", "itviec", "jobsgo", "topcv", "topdev", "vieclam24h", "vietnamworks"]


def test_vietnamworks_cuts_requirements_before_benefits():
    r = of("vietnamworks", LD + "<h2>Yêu cầu công việc</h2><div>Python<br>Benefits:<br>abc</div>")
    assert (r["title"], r["requirements_text"], r["benefit_items"], r["source_external_job_id"], r["issues"]) == ("Engineer", "Python", ["Bonus", "Lunch"], "J1", [])
    assert of("vietnamworks", "<h1>T</h1>")["issues"][0]["code"] == "job_posting_json_ld_not_found"


def test_topdev_infers_a_category():
    r = of("topdev", LD + "<h2>Your role &amp; responsibilities</h2><div>Do it</div>")
    assert r["description_text"] == "Do it" and r["categories_raw"] == ["Information Technology"] and r["issues"][0]["severity"] == "info" and r["domains_raw"] == ["IT", "Software"]


def element(tag, body="", **attributes):
    names = {"cls": "class"}
    return f"<{tag}" + "".join(f' {names.get(k, k).replace("_", "-")}="{v}"' for k, v in attributes.items()) + f">{body}</{tag}>"


def test_itviec_prefers_the_visible_address():
    head = element("h1", "Baker") + element("div", "Bread Ltd", cls="employer-name")
    tags = "".join(element("a", name, href=f"/it-jobs/{name.lower()}") for name in ("Yeast", "Ovens"))
    page = LD + element("div", head, cls="job-header-info") + element("div", element("span", "12 Mill Lane", cls="normal-text"), cls="job-show-info")
    page += element("div", element("h2", "Job description") + element("p", "Knead"), cls="imy-5 paragraph") + element("div", "Skills:") + element("div", tags)
    r = of("itviec", page)
    assert (r["title"], r["employer_name_raw"], r["description_text"], r["locations_raw"], r["skills_raw"]) == ("Baker", "Bread Ltd", "Knead", ["12 Mill Lane"], ["Yeast", "Ovens"])


def test_topcv_layouts():
    box = "box-job-information-detail-item"
    label = "Mô tả công việc"
    part = element("h2", label, cls=f"{box}__title--title") + element("div", f"{label}<br>Knead", cls=f"{box}__text")
    crumbs = element("div", "".join(element("a", x) for x in ("Start", "Food", "Baker")), cls="ctn-breadcrumb-detail")
    r = of("topcv", element("div", id="job-detail", data_job_title="Baker") + crumbs + element("div", part, cls=box))
    assert (r["source_variant"], r["title"], r["domains_raw"], r["description_text"]) == ("normal", "Baker", ["Food"], "Knead")
    r = of("topcv", '<meta name="keywords" content="rye, oats">' + element("h2", "Miller", cls="premium-job-basic-information__content--title"))
    assert (r["source_variant"], r["title"], r["domains_raw"]) == ("premium", "Miller", ["rye", "oats"])
    assert of("topcv", element("p", "nothing known"))["source_variant"] == "unknown"


def test_label_and_section_sites():
    r = of("devwork", '<div class="header-details"><h1>D</h1><h5>Co</h5><p>Huế</p></div><div class="background-content-job"><h2 class="block-title">Mô tả công việc</h2><div class="block-desc">Do</div></div><div class="job-overview"><div class="location-profile-job"><strong>Kinh nghiệm</strong><span>2 năm</span></div></div>', "https://devwork.vn/viec-lam/77/x/")
    assert (r["title"], r["description_text"], r["experience_raw"], r["source_external_job_id"], r["locations_raw"]) == ("D", "Do", "2 năm", "77", ["Huế"])
    r = of("careerlink", LD + '<h1 id="job-title">C</h1><h2 id="job-skill">S</h2><div>Know</div><div id="job-summary"><div class="job-summary-item"><div class="summary-label">Kinh nghiệm</div><div>3</div></div></div>', "https://www.careerlink.vn/tim-viec-lam/x/99")
    assert (r["title"], r["requirements_text"], r["experience_raw"], r["source_external_job_id"], r["categories_raw"]) == ("C", "Know", "3", "99", ["IT", "Software"])
    r = of("careerviet", '<h2 class="detail-title">Mô tả công việc</h2><div>Do</div><h2 class="detail-title">Phúc lợi</h2>', "https://careerviet.vn/vi/x.35C5ABCD.html")
    assert (r["description_text"], r["benefits_text"], r["source_external_job_id"]) == ("Do", None, "35C5ABCD")
    r = of("jobsgo", '<div class="job-detail-card"><h3 class="section-title">Yêu cầu công việc:</h3><div>Know</div></div><span class="text-muted">Ngày đăng tuyển:</span><strong>02/01/2024</strong>', "https://jobsgo.vn/viec-lam/a-12.html")
    assert (r["requirements_text"], r["posted_at"], r["source_external_job_id"]) == ("Know", "2024-01-02", "12")


def test_hydration_site():
    api = {"jobDetailHiddenContact": {"code": 200, "data": {"id": 5, "title": "H", "employer_info": {"name": "Co"}, "description_html": "<p>a</p>", "occupation_ids_main": [2], "places": [{"address": "1 A", "province_id": 7}], "skills_new": ["x"]}}, "initCommon": {"code": 200, "data": {"occupation": [{"id": 2, "name": "IT"}], "provinces": [{"id": 7, "name": "Huế"}]}}}
    r = of("vieclam24h", f'<script id="__NEXT_DATA__">{json.dumps({"props": {"initialState": {"api": api}}})}</script>')
    assert (r["title"], r["employer_name_raw"], r["description_text"], r["categories_raw"], r["locations_raw"], r["skills_raw"], r["source_external_job_id"]) == ("H", "Co", "a", ["IT"], ["1 A, Huế"], ["x"], "5")
    assert of("vieclam24h", '<script id="__NEXT_DATA__">{bad</script>')["title"] is None


def test_listings_and_last_pages():
    s = sites.SITES
    assert sites.listing_urls(s["topdev"], '<a href="/detail-jobs/a?x=1">1</a><a href="https://evil.example/detail-jobs/b">2</a><a href="/detail-jobs/a#z">3</a>', "https://topdev.vn/jobs") == ["https://topdev.vn/detail-jobs/a"]
    assert sites.listing_urls(s["jobsgo"], '<div class="job-list"><div class="job-title"><a href="/viec-lam/a-1.html">x</a></div></div><a href="/viec-lam/b-2.html">y</a>', "https://jobsgo.vn/") == ["https://jobsgo.vn/viec-lam/a-1.html"]
    two = element("div", "".join(element("div", element("a", "x", href=f"/viec-lam/{slug}.html"), cls="job-title") for slug in ("old-7", "new-7", "other-8")), cls="job-list")
    assert sites.listing_urls(s["jobsgo"], two, "https://jobsgo.vn/") == ["https://jobsgo.vn/viec-lam/old-7.html", "https://jobsgo.vn/viec-lam/other-8.html"]
    two = "".join(element("li", element("a", "x", cls="job-link", href=f"/tim-viec-lam/{slug}"), cls="job-item") for slug in ("old/7", "new/7/", "other/8"))
    assert sites.listing_urls(s["careerlink"], two, "https://www.careerlink.vn/") == ["https://www.careerlink.vn/tim-viec-lam/old/7", "https://www.careerlink.vn/tim-viec-lam/other/8"]
    assert s["jobsgo"].last_page(sites.H.parse("<h1>1.234 việc làm</h1>"), "") == 25
    assert s["careerlink"].last_page(sites.H.parse('<ul class="pagination"><a href="?page=2">2</a><a href="?page=11">11</a></ul>'), "") == 11
    assert s["careerlink"].last_page(sites.H.parse('<ul class="pagination"><li class="active">1</li></ul>'), "") == 1
    assert s["careerviet"].last_page(sites.H.parse('<script>x={\\"totalJobs\\":101,\\"limit\\":50}</script>'), "") == 3
    assert s["topdev"].last_page(sites.H.parse('<button>1</button><button aria-label="Go to page 9">..</button>'), "") == 9


def test_extract_over_rows(spark):
    rows = [("topdev", "https://topdev.vn/detail-jobs/a", LD), ("nobody", "u", "<p>x"), ("topdev", "u", None)]
    pages = spark.createDataFrame(rows, "source string, url string, html string")
    got = {(r.source, r.url): r for r in sites.extract(pages).collect()}
    assert got["topdev", "https://topdev.vn/detail-jobs/a"].title == "Engineer" and got["nobody", "u"].issues[0].code == "unknown_source" and got["topdev", "u"].title is None
    assert sites.discover(pages).count() == 0 and sites.last_pages(pages).count() == 3


def test_store(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}")
    assert store.read("t", schema="k int").count() == 0
    for n in range(1, 6):
        assert store.write("t", spark.range(n), keep=2) == n
    assert store.read("t").count() == 5 and store.read("t", 4).count() == 4
    with pytest.raises(FileNotFoundError):
        store.read("t", 1)
    with pytest.raises(RuntimeError):
        store.write("t", spark.range(1), expect=2)
    with store.locked("t"), pytest.raises(RuntimeError):
        store.change("t", lambda df: df)
    with pytest.raises(ZeroDivisionError):
        store.change("t", lambda df: 1 / 0)
    assert store.read("t").count() == 5 and store.change("t", lambda df: df.where("id > 2")) == 6 and store.read("t").count() == 2


@pytest.mark.parametrize("dies_at", range(1, 6))
def test_scans_survive_a_crash_after_each_step(spark, tmp_path, dies_at):
    """Whichever step the writer dies after, the batch's second coming ends where a clean run ends."""
    jobs = spark.createDataFrame([(1, "s", "a", "active", 1, "x", None, None), (2, "s", "b", "expired", 2, "x", None, None)], "id long, source string, url string, listing_status string, last_seen_run_id long, tracking_scope_hash string, expired_at timestamp_ntz, expired_run_id long")
    run = "struct<id:bigint,source:string,phase:string,status:string,expected_targets:array<string>,cdc_status:string,cdc_reason:string,scope_hash:string,coverage_complete:boolean,expired_url_count:bigint,reappeared_url_count:bigint,cdc_finished_at:timestamp_ntz>"
    batch = spark.createDataFrame([((2, "s", "full", "running", ["t"], "pending", None, "x", None, None, None, None), [(2, "t", True, "completed")])], f"run {run}, targets array<struct<run_id:bigint,target_name:string,coverage_complete:boolean,status:string>>")
    at, states = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), []
    for crash in (False, True):
        store = TableStore(spark, f"file://{tmp_path}/{crash}")
        store.write("jobs", jobs)
        store.write("scopes", spark.createDataFrame([("s", "x", 1)], "source string, scope_hash string, last_applied_run_id long"))
        write = streams.scan_writer(store, at)
        if crash:
            left, place = [dies_at], store._place

            def dying(path, text):
                place(path, text)
                left[0] -= 1
                if not left[0]:
                    raise KeyboardInterrupt

            store._place = dying
            with pytest.raises(KeyboardInterrupt):
                write(batch, 0)
            store = TableStore(spark, f"file://{tmp_path}/{crash}")
            store._write_file(f"{store.root}/.lock-scans", '{"owner": "scan-stream"}', False)  # a killed writer leaves its lock
            write = streams.scan_writer(store, at)
        write(batch, 0)
        states.append({t: sorted(map(str, store.read(t).collect())) for t in ("jobs", "events", "runs", "scopes")})
    assert states[0] == states[1] and len(states[0]["events"]) == 2


def test_raw_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>x")
    assert raw.read_objects(spark, str(tmp_path), "*.html").first().content == b"<p>x" and "content" not in raw.list_objects(spark, str(tmp_path)).columns
    assert raw.write_checked(spark.createDataFrame([(1,), (1,), (2,)], "k int"), str(tmp_path / "out"), "k") == 2


def test_configs(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("source: a\ndiscovery: {pagination: {strategy: until_empty}, targets: [{name: x, total_pages: 3}, {name: y, enabled: false}]}")
    found = configs.source_configs(tmp_path)
    assert configs.sources_table(spark, found).first().targets == ["x"] and configs.targets_table(spark, found).first().last_page == 3
    (tmp_path / "b.yaml").write_text("source: a")
    with pytest.raises(ValueError):
        configs.source_configs(tmp_path)


def test_reports(spark, tmp_path):
    inv = spark.createDataFrame([("a|b", 1)], "source string, total_jobs long")
    alerts = spark.createDataFrame([("a|b", "m", 1.0, 0.0)], "source string, metric string, observed double, threshold double")
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    report = reports.build({"inventory": inv, "empty": inv.where("total_jobs < 0")}, alerts, now, ["z"])
    assert report["sources_without_jobs"] == ["z"]
    paths = reports.save(report, tmp_path)
    assert "a\\|b" in paths[1].read_text() and "No records." in paths[1].read_text()
    assert policy.newest_report(tmp_path, ["z"], now=now)[1]["sources"] == ["a|b", "z"]
    for bad in ({"now": datetime(2024, 2, 1, tzinfo=timezone.utc)}, {"policy_sources": ["q"], "now": now}):
        with pytest.raises(ValueError):
            policy.newest_report(tmp_path, **({"policy_sources": ["z"]} | bad))
    (tmp_path / "99999999T.json").write_text("{")
    with pytest.raises(ValueError):
        policy.newest_report(tmp_path, ["z"], now=now)
    assert [policy.exit_code(x) for x in ([], [1], None)] == [0, 1, 2]


def test_streams(spark, tmp_path):
    rows = [(1, "u", datetime(2024, 1, 1, 0, m)) for m in (0, 1, 2)] + [(1, "v", datetime(2024, 1, 1, 3))]
    spark.createDataFrame(rows, "run_id long, url string, seen_at timestamp").write.parquet(str(tmp_path / "in"))
    stream = streams.read_table_stream(spark, str(tmp_path / "in"), "run_id long, url string, seen_at timestamp")
    streams.run_available(streams.unique_urls(stream), str(tmp_path / "c1"), table="uniq")
    assert spark.table("uniq").count() == 2
    streams.run_available(streams.tumbling_counts(stream, "seen_at", "1 hour", ["run_id"]), str(tmp_path / "c2"), table="tumb", mode="complete")
    assert sorted(r.rows for r in spark.table("tumb").collect()) == [1, 3]
    streams.run_available(streams.sessions(stream, "seen_at", "30 minutes", ["run_id"]), str(tmp_path / "c3"), table="sess", mode="complete")
    assert sorted(r.rows for r in spark.table("sess").collect()) == [1, 3]


def test_stale_attempts_stream(spark, tmp_path):
    t = lambda h: datetime(2024, 1, 1, h)
    schema = "job_id long, status string, started_at timestamp"
    for n, rows in enumerate([[(1, "parsing", t(0)), (2, "parsing", t(0))], [(2, "success", t(1))], [(3, "success", t(20))], [(3, "success", t(21))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    streams.run_available(streams.stale_attempts(stream), str(tmp_path / "c"), table="stale")
    assert [r.job_id for r in spark.table("stale").collect()] == [1]


def test_scan_stream(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/state")
    store.write("jobs", spark.createDataFrame([(1, "s", "a", "active", 1, "x", None, None), (2, "s", "b", "active", 2, "x", None, None)], "id long, source string, url string, listing_status string, last_seen_run_id long, tracking_scope_hash string, expired_at timestamp_ntz, expired_run_id long"))
    store.write("scopes", spark.createDataFrame([("s", "x", 1)], "source string, scope_hash string, last_applied_run_id long"))
    run = "struct<id:bigint,source:string,phase:string,status:string,expected_targets:array<string>,cdc_status:string,cdc_reason:string,scope_hash:string,coverage_complete:boolean,expired_url_count:bigint,reappeared_url_count:bigint,cdc_finished_at:timestamp_ntz>"
    batch = spark.createDataFrame([((2, "s", "full", "running", ["t"], "pending", None, "x", None, None, None, None), [(2, "t", True, "completed")])], f"run {run}, targets array<struct<run_id:bigint,target_name:string,coverage_complete:boolean,status:string>>")
    batch.write.parquet(str(tmp_path / "scans"))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    write = streams.scan_writer(store, at)
    streams.run_available(streams.read_table_stream(spark, str(tmp_path / "scans"), batch.schema), str(tmp_path / "c"), each=write)
    assert {r.url: r.listing_status for r in store.read("jobs").collect()} == {"a": "expired", "b": "active"} and store.read("events").count() == 1
    write(batch, 1)
    assert store.read("events").count() == 1
