"""The fetch and parse state machine: claims, outcomes, recovery, exhaustion, integrity, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listweave.vocabulary import FETCH_BUSY

#: Outcomes of a parse that are final for an object and parser version.
FINAL_PARSE = ("success", "raw_missing", "raw_corrupt")


def fetch_queue(jobs: DataFrame, at: Column, limit: int, max_attempts: int, run_id: int | None = None) -> DataFrame:
    """The next jobs to fetch: pending ones and due retries with tries left, oldest first.

    With ``run_id``, jobs that the run has tried already wait for the next run.
    """
    due = (F.col("raw_status") == "pending") | ((F.col("raw_status") == "retryable_error") & (F.coalesce("next_retry_at", at) <= at))
    x = jobs.where(due & (F.coalesce("fetch_attempt_count", F.lit(0)) < max_attempts))
    if run_id is not None and "last_attempt_run_id" in jobs.columns:
        x = x.where(~F.col("last_attempt_run_id").eqNullSafe(F.lit(run_id)))
    return x.orderBy(F.asc("first_seen_at"), "id").limit(limit)


def after_fetch(jobs: DataFrame, outcomes: DataFrame, at: Column, base_seconds: float, most_seconds: float, max_attempts: int) -> DataFrame:
    """``jobs`` after ``outcomes(id, ok, retryable, blocked, error_type, http_status)`` of one try each."""
    o = outcomes.select("id", *[F.col(c).alias(f"_{c}") for c in ("ok", "retryable", "blocked", "error_type", "http_status")], F.lit(True).alias("_hit"))
    x = jobs.join(o, "id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    tries = F.coalesce("fetch_attempt_count", F.lit(0)) + 1
    again = F.col("_retryable") & (tries < max_attempts)
    status = F.when(F.col("_ok"), "raw_ready").when(F.col("_blocked"), "blocked").when(again, "retryable_error").otherwise("permanent_error")
    wait = F.least(F.lit(float(most_seconds)), F.lit(float(base_seconds)) * F.pow(F.lit(2.0), tries - 1))
    new = {
        "raw_status": status, "fetch_attempt_count": tries, "last_attempt_at": at,
        "last_error_type": F.when(~F.col("_ok"), F.col("_error_type")), "last_http_status": F.col("_http_status"),
        "next_retry_at": F.when(status == "retryable_error", at + F.make_dt_interval(secs=wait.cast("decimal(18,6)"))),
    }
    return x.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items() if c in jobs.columns}).select(*jobs.columns)


def parse_queue(raw_objects: DataFrame, attempts: DataFrame, parser: str, version: str, max_attempts: int, run_id: int | None = None, limit: int | None = None) -> DataFrame:
    """Raw objects to parse: present, no final outcome and no running attempt for this parser version,
    tries left, and not tried in this run.  Attempts before the object was stored anew do not count."""
    own = attempts.where((F.col("parser_name") == parser) & (F.col("parser_version") == version)).join(
        raw_objects.select(F.col("id").alias("raw_object_id"), "stored_at"), "raw_object_id"
    ).where(F.col("stored_at").isNull() | (F.col("started_at") >= F.col("stored_at")))
    tried = F.col("run_id").eqNullSafe(F.lit(run_id)) if run_id is not None and "run_id" in attempts.columns else F.lit(False)
    seen = own.groupBy(F.col("raw_object_id").alias("id")).agg(
        F.count("*").alias("tries"),
        F.bool_or(F.col("status").isin(*FINAL_PARSE)).alias("_final"),
        F.bool_or(F.col("status") == "parsing").alias("_running"),
        F.bool_or(tried).alias("_tried"),
    )
    x = raw_objects.where("purged_at is null").join(seen, "id", "left")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    x = x.where(no("_final") & no("_running") & no("_tried") & (F.coalesce("tries", F.lit(0)) < max_attempts))
    x = x.withColumn("tries", F.coalesce("tries", F.lit(0))).drop("_final", "_running", "_tried").orderBy("fetched_at", "id")
    return x.limit(limit) if limit else x


def exhausted_parses(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """Objects and parser versions that used up their tries without a final outcome."""
    return attempts.groupBy("raw_object_id", "parser_name", "parser_version").agg(
        F.count("*").alias("tries"), F.bool_or(F.col("status").isin(*FINAL_PARSE)).alias("_final")
    ).where((F.col("tries") >= max_attempts) & ~F.col("_final")).drop("_final")


def recover_stale_fetches(jobs: DataFrame, stale: Column, at: Column) -> DataFrame:
    """Jobs stuck in a fetch since before ``stale`` become due retries."""
    stuck = F.col("raw_status").isin(*FETCH_BUSY) & (F.col("updated_at") < stale)
    new = {"raw_status": F.lit("retryable_error"), "next_retry_at": at, "last_error_type": F.lit("stale_recovery"), "updated_at": at}
    # the condition reads updated_at and raw_status, so all columns change in one projection
    return jobs.select(*[F.when(stuck, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in jobs.columns])


def recover_stale_parses(attempts: DataFrame, stale: Column, at: Column) -> DataFrame:
    stuck = (F.col("status") == "parsing") & (F.col("started_at") < stale)
    new = {"status": F.lit("parse_error"), "error_type": F.lit("stale_recovery"), "finished_at": at}
    return attempts.select(*[F.when(stuck, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in attempts.columns])


def audit_objects(raw_objects: DataFrame, listing: DataFrame) -> DataFrame:
    """Metadata against the object listing(object_key, length): valid, missing or size_mismatch."""
    there = listing.select("object_key", F.col("length").alias("_length"))
    x = raw_objects.where("purged_at is null").join(there, "object_key", "left")
    verdict = F.when(F.col("_length").isNull(), "missing").when(F.col("_length") != F.col("content_length_bytes"), "size_mismatch").otherwise("valid")
    return x.withColumn("integrity_status", verdict).drop("_length")


def check_content(objects: DataFrame) -> DataFrame:
    """Objects with their bytes: size, hash and encoding in that order; null integrity_error is fine."""
    data = F.col("content")
    error = (
        F.when(data.isNull(), "raw_missing")
        .when(F.octet_length(data) != F.col("content_length_bytes"), "size_mismatch")
        .when(F.sha2(data, 256) != F.col("content_sha256"), "hash_mismatch")
        .when(~F.is_valid_utf8(data.cast("string")), "not_utf8")
    )
    return objects.withColumn("integrity_error", error)


def retention_candidates(jobs: DataFrame, raw_objects: DataFrame, attempts: DataFrame, results: DataFrame, runs: DataFrame, scopes: DataFrame, at: Column, expired_days: int = 7, unknown_days: int = 30) -> DataFrame:
    """Raw objects that may go: parsed as they are, not being parsed, and either expired for some days
    and not seen since, or of unknown presence, old, and missed by two complete scans of the current
    scope that lie a week apart."""
    if min(expired_days, unknown_days) < 1:
        raise ValueError("days must be 1 or more")
    r = raw_objects.where(F.col("purged_at").isNull()).select(
        F.col("id").alias("raw_object_id"), "job_id", "object_key", "bucket_name", "content_sha256", "content_length_bytes", "stored_at"
    )
    j = jobs.where(F.col("raw_status").isin("raw_ready", "storage_missing")).select(
        F.col("id").alias("job_id"), "source", F.col("listing_status").alias("reason"), "expired_at", "last_seen_at"
    )
    busy = attempts.where("status = 'parsing'").select("job_id").distinct()
    parsed = results.where("is_current").select(
        "job_id", F.col("raw_sha256").alias("content_sha256"), F.col("raw_bucket").alias("bucket_name"), F.col("raw_object_key").alias("object_key")
    ).distinct()
    x = r.join(j, "job_id").join(busy, "job_id", "left_anti").join(parsed, ["job_id", "content_sha256", "bucket_name", "object_key"], "left_semi")
    ago = lambda d: at - F.make_dt_interval(days=F.lit(d))
    gone = (F.col("reason") == "expired") & (F.col("expired_at") < ago(expired_days)) & (F.col("last_seen_at") < F.col("expired_at"))
    old = (F.col("reason") == "unknown") & (F.col("stored_at") < ago(unknown_days))
    # complete scans of the current scope.  What those after some time amount to only shrinks as that
    # time moves on, so one time a source says it all: objects last seen before it have been missed
    scans = runs.join(scopes.select("source", "scope_hash"), ["source", "scope_hash"], "left_semi").where(
        F.col("cdc_status").isin("baseline", "applied") & F.col("coverage_complete")
    ).select("source", F.col("started_at").alias("_began"), F.col("cdc_finished_at").alias("_ended"))
    on = Window.partitionBy("source").orderBy(F.desc("_began")).rangeBetween(Window.unboundedPreceding, 0)
    week = F.max("_ended").over(on) - F.make_dt_interval(days=F.lit(7)) >= F.min("_ended").over(on)
    enough = scans.withColumn("_enough", (F.count("*").over(on) >= 2) & week).where("_enough")
    missed = enough.groupBy("source").agg(F.max("_began").alias("_missed"))
    return x.join(missed, "source", "left").where(gone | (old & (F.col("last_seen_at") < F.col("_missed")))).select(*x.columns)


def within_budget(candidates: DataFrame, max_objects: int, max_bytes: int, per: str = "source") -> DataFrame:
    """``candidates`` with ``selected``: oldest first while objects and bytes last; one that does not fit
    is passed over and later ones may still fit.

    Each ``per`` group has a budget of its own; a group is folded in order inside one expression.
    """
    item = F.struct("stored_at", "raw_object_id", "content_length_bytes")
    groups = candidates.groupBy(per).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("b"), F.array().cast("array<bigint>").alias("ids"))

    def step(acc, x):
        fits = (acc["n"] < max_objects) & (acc["b"] + x["content_length_bytes"] <= max_bytes)
        took = F.struct((acc["n"] + 1).alias("n"), (acc["b"] + x["content_length_bytes"]).alias("b"), F.concat(acc["ids"], F.array(x["raw_object_id"])).alias("ids"))
        return F.when(fits, took).otherwise(acc)

    chosen = groups.select(F.explode(F.aggregate("_items", start, step)["ids"]).alias("raw_object_id")).withColumn("selected", F.lit(True))
    return candidates.join(chosen, "raw_object_id", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def retention_report(chosen: DataFrame) -> DataFrame:
    return chosen.groupBy("source", "reason").agg(
        F.count("*").alias("objects"), F.sum("content_length_bytes").alias("bytes"),
        F.count_if("selected").alias("selected_objects"), F.coalesce(F.sum(F.when(F.col("selected"), F.col("content_length_bytes"))), F.lit(0)).alias("selected_bytes"),
    )


def merge_posting_dates(postings: DataFrame) -> DataFrame:
    """One row a listing: earliest first sight, latest last sight."""
    return postings.groupBy("source_id", "canonical_url").agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))


def current_results(versions: DataFrame) -> DataFrame:
    """Versions of parse results with is_current on the newest of each posting."""
    order = Window.partitionBy("source_posting_id").orderBy(F.desc("fetched_at"), F.desc("id"))
    return versions.withColumn("is_current", F.row_number().over(order) == 1)


def cleanup_log(chosen: DataFrame, outcomes: DataFrame, at: Column) -> DataFrame:
    """Journal of a clean-up: selected objects with what became of them (object_key, state), else pending."""
    done = outcomes.select("object_key", F.col("state").alias("_state"))
    return chosen.where("selected").join(done, "object_key", "left").select(
        "job_id", "bucket_name", "object_key", "content_sha256", F.col("content_length_bytes").alias("bytes"), "reason",
        F.coalesce("_state", F.lit("pending")).alias("status"), at.alias("created_at"), F.when(F.col("_state").isNotNull(), at).alias("finished_at"),
    )


def after_cleanup(jobs: DataFrame, raw_objects: DataFrame, log: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(jobs, raw objects) after a clean-up: what is deleted or missing is purged; what changed stays."""
    gone = log.where(F.col("status").isin("deleted", "missing")).select("job_id", "object_key")
    hit = gone.select(F.col("job_id").alias("id")).distinct().withColumn("_gone", F.lit(True))
    next_jobs = jobs.join(hit, "id", "left").withColumn("raw_status", F.when(F.col("_gone"), "storage_missing").otherwise(F.col("raw_status"))).select(*jobs.columns)
    keys = gone.select("object_key").distinct().withColumn("_gone", F.lit(True))
    next_raw = raw_objects.join(keys, "object_key", "left").withColumn("purged_at", F.when(F.col("_gone"), at).otherwise(F.col("purged_at"))).select(*raw_objects.columns)
    return next_jobs, next_raw
