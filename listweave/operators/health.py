"""Health sections over the crawl state, their summary, and completeness of parsed fields.

Every section is a DataFrame; ``as_of`` fixes the time for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.functions.dates import hours_between
from listweave.functions.text import blank_to_null
from listweave.operators.tables import latest, top_per_group
from listweave.vocabulary import FETCH_BUSY, FETCH_ERRORS, USABLE_QUALITY

#: Fields whose absence completeness counts.
FIELDS = ("title", "employer_name_raw", "description_text", "requirements_text", "salary_raw")


@dataclass(frozen=True)
class Window_:
    as_of: datetime
    window_hours: int = 24
    stale_hours: int = 6
    samples: int = 5

    def __post_init__(self):
        if not (1 <= self.window_hours <= 8760 and 1 <= self.stale_hours <= 8760 and 1 <= self.samples <= 100):
            raise ValueError("hours must be 1..8760 and samples must be 1..100")

    @staticmethod
    def _literal(at: datetime) -> Column:
        return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")

    @property
    def at(self) -> Column:
        return self._literal(self.as_of)

    @property
    def since(self) -> Column:
        return self._literal(self.as_of - timedelta(hours=self.window_hours))

    @property
    def stale(self) -> Column:
        return self._literal(self.as_of - timedelta(hours=self.stale_hours))


def inventory(jobs: DataFrame, w: Window_) -> DataFrame:
    status, raw = F.col("listing_status"), F.col("raw_status")
    return jobs.groupBy("source").agg(
        F.count("*").alias("total_jobs"),
        *[F.count_if(status == s).alias(s) for s in ("active", "expired", "unknown")],
        F.count_if(F.col("first_seen_at") >= w.since).alias("new_jobs"),
        F.count_if(raw == "pending").alias("pending_fetch"),
        F.count_if((raw == "retryable_error") & (F.col("next_retry_at") <= w.at)).alias("overdue_retry"),
        F.count_if(raw.isin(*FETCH_BUSY) & (F.col("updated_at") < w.stale)).alias("stuck_fetch"),
        F.min(F.when(raw == "pending", F.col("first_seen_at"))).alias("oldest_pending_at"),
    )


def raw_and_backlog(raw_objects: DataFrame, jobs: DataFrame, results: DataFrame) -> DataFrame:
    usable = results.where(F.col("is_current") & F.col("quality_status").isin(*USABLE_QUALITY)).select(
        F.col("crawler_raw_object_id").alias("id"), F.col("raw_sha256").alias("content_sha256"), F.lit(True).alias("_parsed")
    ).distinct()
    o = raw_objects.join(usable, ["id", "content_sha256"], "left").join(jobs.select(F.col("id").alias("job_id"), "source"), "job_id")
    there = F.col("purged_at").isNull()
    waiting = there & F.col("_parsed").isNull()
    return o.groupBy("source").agg(
        F.count_if(there).alias("raw_available"),
        F.count_if(~there).alias("intentionally_purged"),
        F.count_if(waiting).alias("awaiting_usable_parse"),
        F.min(F.when(waiting, F.col("fetched_at"))).alias("oldest_unparsed_at"),
    )


def current_fetch_errors(jobs: DataFrame) -> DataFrame:
    return (
        jobs.where(F.col("raw_status").isin(*FETCH_ERRORS))
        .groupBy("source", "raw_status", F.col("last_error_type").alias("error_type"), F.col("last_http_status").alias("http_status"))
        .agg(F.count("*").alias("jobs"))
    )


def latest_attempts(attempts: DataFrame) -> DataFrame:
    return latest(attempts, ["job_id"], [F.desc("started_at"), F.desc("id")])


def _of_jobs(rows: DataFrame, jobs: DataFrame, *columns: str) -> DataFrame:
    return rows.join(jobs.select(F.col("id").alias("job_id"), "source", *columns), "job_id")


def current_parse_status(attempts: DataFrame, jobs: DataFrame, w: Window_) -> DataFrame:
    stuck = (F.col("status") == "parsing") & (F.col("started_at") < w.stale)
    return _of_jobs(latest_attempts(attempts), jobs).groupBy("source", "status", "parser_version").agg(
        F.count("*").alias("jobs"), F.count_if(stuck).alias("stuck_parse")
    )


def _current_results(results: DataFrame, postings: DataFrame, sources: DataFrame) -> DataFrame:
    p = postings.select(F.col("id").alias("source_posting_id"), "source_id")
    s = sources.select(F.col("id").alias("source_id"), F.col("code").alias("source"))
    return results.where("is_current").join(p, "source_posting_id").join(s, "source_id")


def quality(results: DataFrame, postings: DataFrame, sources: DataFrame) -> DataFrame:
    average = F.round(F.avg(F.col("completeness_score").cast("decimal(20,0)")), 2).cast("double")
    return _current_results(results, postings, sources).groupBy("source", "quality_status").agg(
        F.count("*").alias("jobs"), average.alias("average_completeness")
    )


def freshness(runs: DataFrame, w: Window_) -> DataFrame:
    done = runs.where("status = 'completed'").groupBy("source", "phase").agg(F.max("finished_at").alias("last_success_at"))
    return done.withColumn("hours_since_success", hours_between(w.at, "last_success_at"))


def runs_in_window(runs: DataFrame, w: Window_) -> DataFrame:
    sums = {"discovered_url_count": "discovered_urls", "new_url_count": "new_urls", "expired_url_count": "expired_urls", "reappeared_url_count": "reappeared_urls"}
    return runs.where(F.col("started_at") >= w.since).groupBy("source", "phase", "status", "cdc_status", "cdc_reason").agg(
        F.count("*").alias("runs"), *[F.sum(c).alias(n) for c, n in sums.items()]
    )


def attempts_in_window(attempts: DataFrame, jobs: DataFrame, w: Window_, detail: str) -> DataFrame:
    """Attempts by status, error and ``detail`` (http_status for fetches, parser_version for parses)."""
    return _of_jobs(attempts.where(F.col("started_at") >= w.since), jobs).groupBy("source", "status", "error_type", detail).agg(
        F.count("*").alias("attempts"), F.countDistinct("job_id").alias("affected_jobs")
    )


def parse_outcomes_in_window(attempts: DataFrame, jobs: DataFrame, w: Window_) -> DataFrame:
    """The last ended attempt of each job in the window; attempts still running do not hide it."""
    ended = attempts.where((F.col("started_at") >= w.since) & (F.col("status") != "parsing"))
    return _of_jobs(latest_attempts(ended), jobs).groupBy("source", "status").agg(F.count("*").alias("jobs"))


def issue_samples(jobs: DataFrame, attempts: DataFrame, w: Window_) -> DataFrame:
    fetch = jobs.where(F.col("raw_status").isin(*FETCH_ERRORS)).select(
        "source", F.col("id").alias("job_id"), "url", F.lit("fetch").alias("stage"), F.col("raw_status").alias("status"),
        F.col("last_error_type").alias("error_type"), F.col("last_attempt_at").alias("occurred_at"), F.col("fetch_attempt_count").alias("attempts"),
    )
    parse = _of_jobs(latest_attempts(attempts).where(~F.col("status").isin("success", "parsing")), jobs, "url").select(
        "source", "job_id", "url", F.lit("parse").alias("stage"), "status", "error_type", F.col("started_at").alias("occurred_at"), F.col("attempt_number").alias("attempts"),
    )
    return top_per_group(fetch.unionByName(parse), ["source", "stage", "status", "error_type"], [F.desc_nulls_last("occurred_at"), F.col("job_id")], w.samples)


def completeness(results: DataFrame, postings: DataFrame, sources: DataFrame) -> DataFrame:
    missing = {f"missing_{f}": F.count_if(blank_to_null(f).isNull()) for f in FIELDS}
    missing["missing_location_cities"] = F.count_if(F.coalesce(F.size("location_cities"), F.lit(0)) == 0)
    out = _current_results(results, postings, sources).groupBy("source").agg(F.count("*").alias("current_parses"), *[c.alias(n) for n, c in missing.items()])
    return out.withColumns({f"{n}_pct": percent(F.col(n), F.col("current_parses")) for n in missing})


def percent(part: Column, whole: Column) -> Column:
    """Percent with two decimals; null of nothing."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)


def summary(expected: DataFrame, inventory_: DataFrame, fetch_errors: DataFrame, parse_status: DataFrame) -> DataFrame:
    """A row for each expected or seen source, those without jobs included."""
    names = expected.select("source")
    for section in (inventory_, fetch_errors, parse_status):
        names = names.unionByName(section.select("source"))
    failed = ~F.col("status").isin("success", "parsing")
    f = fetch_errors.groupBy("source").agg(F.sum("jobs").alias("_f"))
    p = parse_status.where(failed).groupBy("source").agg(F.sum("jobs").alias("_p"))
    out = names.distinct().join(inventory_.select("source", "total_jobs"), "source", "left").join(f, "source", "left").join(p, "source", "left")
    zero = F.lit(0).cast("long")
    out = out.select("source", F.coalesce("total_jobs", zero).alias("total_jobs"), F.coalesce("_f", zero).alias("current_fetch_errors"), F.coalesce("_p", zero).alias("latest_parse_errors"))
    return out.withColumn("current_fetch_error_pct", percent(F.col("current_fetch_errors"), F.col("total_jobs")))


def collect_report(tables: dict[str, DataFrame], expected: DataFrame, w: Window_) -> dict[str, DataFrame]:
    """All sections by name from jobs, raw_objects, results, postings, sources, runs and both kinds of attempts."""
    t = tables
    sections = {
        "inventory": inventory(t["jobs"], w),
        "raw_and_backlog": raw_and_backlog(t["raw_objects"], t["jobs"], t["results"]),
        "current_fetch_errors": current_fetch_errors(t["jobs"]),
        "current_parse_status": current_parse_status(t["parse_attempts"], t["jobs"], w),
        "quality": quality(t["results"], t["postings"], t["sources"]),
        "freshness": freshness(t["runs"], w),
        "runs_in_window": runs_in_window(t["runs"], w),
        "fetch_attempts_in_window": attempts_in_window(t["fetch_attempts"], t["jobs"], w, "http_status"),
        "parse_attempts_in_window": attempts_in_window(t["parse_attempts"], t["jobs"], w, "parser_version"),
        "parse_outcomes_in_window": parse_outcomes_in_window(t["parse_attempts"], t["jobs"], w),
        "issue_samples": issue_samples(t["jobs"], t["parse_attempts"], w),
        "completeness": completeness(t["results"], t["postings"], t["sources"]),
    }
    return {"summary": summary(expected, sections["inventory"], sections["current_fetch_errors"], sections["current_parse_status"]), **sections}
