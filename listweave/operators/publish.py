"""Publishing: projection of active listings, guards, difference, reconciliation and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.functions.text import blank_to_null, join_items
from listweave.operators.tables import or_join
from listweave.vocabulary import USABLE_QUALITY

# Published columns.
JOB_COLUMNS = (
    "id", "source_id", "canonical_url", "title", "employer_name_raw", "description_text", "requirements_text", "benefits_text", "categories_raw",
    "skills_raw", "location_cities", "salary_raw", "employment_type_raw", "experience_raw", "posted_at", "expires_at", "first_seen_at", "last_seen_at",
)
SOURCE_COLUMNS = ("id", "code", "display_name")


class PublishRefused(ValueError):
    """A guard found rows that must not be there."""


def staged_state(postings: DataFrame, sources: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every posting with its listing's status, where posting, source and listing agree."""
    s = sources.select(F.col("id").alias("source_id"), F.col("code").alias("source"))
    j = jobs.select(F.col("id").alias("crawler_job_id"), "source", "listing_status", "last_seen_at")
    p = postings.select("id", "source_id", "canonical_url", "crawler_job_id", "first_seen_at")
    return p.join(s, "source_id").join(j, ["crawler_job_id", "source"])


def staged_jobs(postings: DataFrame, sources: DataFrame, jobs: DataFrame, results: DataFrame) -> DataFrame:
    """The rows to publish: active, current, usable, with a title; benefits fall back to their items."""
    r = results.where(F.col("is_current") & F.col("quality_status").isin(*USABLE_QUALITY) & blank_to_null("title").isNotNull())
    x = staged_state(postings, sources, jobs).where("listing_status = 'active'").join(r.withColumnRenamed("id", "result_id"), F.col("id") == F.col("source_posting_id"))
    benefits = F.coalesce(blank_to_null("benefits_text"), join_items("benefit_items"))
    return x.withColumn("benefits_text", benefits).select(*JOB_COLUMNS)


def broken_mappings(postings: DataFrame, sources: DataFrame, jobs: DataFrame) -> DataFrame:
    """Postings without a source or listing, or whose listing belongs to another source."""
    s = sources.select(F.col("id").alias("source_id"), "code")
    j = jobs.select(F.col("id").alias("crawler_job_id"), F.col("source").alias("_source"), F.lit(True).alias("_job"))
    x = postings.join(s, "source_id", "left").join(j, "crawler_job_id", "left")
    return x.where(F.col("code").isNull() | F.col("_job").isNull() | ~F.col("_source").eqNullSafe(F.col("code"))).select(*postings.columns)


def uncommitted_active(jobs: DataFrame, scopes: DataFrame, runs: DataFrame) -> DataFrame:
    """Active listings that no complete, applied scan of the current scope stands behind."""
    c = scopes.select("source", F.col("scope_hash").alias("_scope"), F.col("last_applied_run_id").alias("_run"))
    r = runs.select(F.col("id").alias("_run"), F.col("source").alias("_owner"), F.col("coverage_complete").alias("_whole"), "cdc_status")
    x = jobs.where("listing_status = 'active'").join(c, "source", "left").join(r, "_run", "left")
    bad = (
        F.col("_scope").isNull() | ~F.col("tracking_scope_hash").eqNullSafe(F.col("_scope")) | ~F.col("_owner").eqNullSafe(F.col("source"))
        | ~F.coalesce("_whole", F.lit(False)) | ~F.coalesce(F.col("cdc_status").isin("baseline", "applied"), F.lit(False))
    )
    return x.where(bad).select(*jobs.columns)


def source_collisions(serving_sources: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources that share an id or a code with a published one but not both."""
    met = or_join(serving_sources.select("id", "code"), sources.select("id", "code"), [("id", "id"), ("code", "code")])
    return met.where((F.col("a.id") != F.col("b.id")) | (F.col("a.code") != F.col("b.code")))


def foreign_rows(serving_jobs: DataFrame, serving_sources: DataFrame, state: DataFrame, sources: DataFrame) -> DataFrame:
    """Ids of published rows whose identity differs here, and of published sources unknown here."""
    s = state.select("id", F.col("source_id").alias("_source"), F.col("canonical_url").alias("_url"))
    moved = serving_jobs.join(s, "id").where(~(F.col("source_id").eqNullSafe(F.col("_source")) & F.col("canonical_url").eqNullSafe(F.col("_url"))))
    return moved.select(F.lit("job").alias("kind"), "id").unionByName(
        serving_sources.join(sources.select("id"), "id", "left_anti").select(F.lit("source").alias("kind"), "id")
    )


def guards(t: dict[str, DataFrame], serving_jobs: DataFrame, serving_sources: DataFrame) -> dict[str, DataFrame]:
    """The refusals by name; each must be empty before anything is published."""
    state = staged_state(t["postings"], t["sources"], t["jobs"])
    none = t["sources"].agg(F.count("*").alias("n")).where("n = 0")
    return {
        "broken_mappings": broken_mappings(t["postings"], t["sources"], t["jobs"]),
        "uncommitted_active": uncommitted_active(t["jobs"], t["scopes"], t["runs"]),
        "no_sources": none,
        "source_collisions": source_collisions(serving_sources, t["sources"]),
        "foreign_rows": foreign_rows(serving_jobs, serving_sources, state, t["sources"]),
    }


def enforce(checks: dict[str, DataFrame]) -> None:
    for name, rows in checks.items():
        if not rows.isEmpty():
            raise PublishRefused(f"{name}: rows that must not be there; nothing is published")


def _differs(columns: tuple[str, ...]) -> Column:
    return ~F.struct(*[F.col(f"s.{c}") for c in columns]).eqNullSafe(F.struct(*[F.col(f"t.{c}") for c in columns]))


def changes(serving: DataFrame, staged: DataFrame, state: DataFrame, columns: tuple[str, ...] = JOB_COLUMNS) -> DataFrame:
    """One row: inserts, updates, deletes, retained rows to refresh, active listings without content."""
    s, t = staged.alias("s"), serving.alias("t")
    met = s.join(t, F.col("s.id") == F.col("t.id"), "left").agg(
        F.count_if(F.col("t.id").isNull()).alias("inserts"), F.count_if(F.col("t.id").isNotNull() & _differs(columns)).alias("updates")
    )
    active = state.where("listing_status = 'active'").select("id", F.col("last_seen_at").alias("_seen"))
    kept = serving.join(active, "id").join(staged.select("id"), "id", "left_anti")
    numbers = [
        met.select(F.posexplode(F.array("inserts", "updates")).alias("i", "n")).select(F.when(F.col("i") == 0, "inserts").otherwise("updates").alias("change"), "n"),
        serving.join(active, "id", "left_anti").agg(F.count("*").alias("n")).select(F.lit("deletes").alias("change"), "n"),
        kept.where(~F.col("last_seen_at").eqNullSafe(F.col("_seen"))).agg(F.count("*").alias("n")).select(F.lit("refresh_retained").alias("change"), "n"),
        active.join(staged.select("id"), "id", "left_anti").agg(F.count("*").alias("n")).select(F.lit("active_without_content").alias("change"), "n"),
    ]
    out = numbers[0]
    for n in numbers[1:]:
        out = out.unionByName(n)
    return out


def reconcile(serving: DataFrame, staged: DataFrame, state: DataFrame, at: Column) -> DataFrame:
    """Next published table: staged rows, and active rows without new content as they were but for
    last_seen_at; all else goes.  ``updated_at`` moves only where something changed."""
    values = [c for c in staged.columns if c != "id"]
    old = serving.select("id", F.struct(*values).alias("_old"), F.col("updated_at").alias("_stamp"))
    same = F.struct(*values).eqNullSafe(F.col("_old"))
    fresh = staged.join(old, "id", "left").select(*staged.columns, F.when(same, F.col("_stamp")).otherwise(at).alias("updated_at"))
    active = state.where("listing_status = 'active'").select("id", F.col("last_seen_at").alias("_seen"))
    kept = serving.join(staged.select("id"), "id", "left_anti").join(active, "id")
    moved = ~F.col("last_seen_at").eqNullSafe(F.col("_seen"))
    kept = kept.withColumn("updated_at", F.when(moved, at).otherwise(F.col("updated_at"))).withColumn("last_seen_at", F.col("_seen")).drop("_seen")
    return fresh.unionByName(kept.select(*fresh.columns))


def unverified(published: DataFrame, staged: DataFrame, state: DataFrame) -> DataFrame:
    """What a published table still owes to the staged one; all zero after a reconciliation."""
    return changes(published, staged, state).where("change <> 'active_without_content' and n > 0")


def publish_log(state: DataFrame, staged: DataFrame, serving: DataFrame) -> DataFrame:
    """By source: active listings, staged and published rows."""
    a = state.where("listing_status = 'active'").groupBy("source_id").agg(F.count("*").alias("active"))
    b = staged.groupBy("source_id").agg(F.count("*").alias("staged"))
    c = serving.groupBy("source_id").agg(F.count("*").alias("published"))
    zero = F.lit(0).cast("long")
    return a.join(b, "source_id", "full").join(c, "source_id", "full").select("source_id", *[F.coalesce(x, zero).alias(x) for x in ("active", "staged", "published")])
