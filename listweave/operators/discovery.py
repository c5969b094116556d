"""Discovery: page ranges, stop rules, counters, coverage, and the registry of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listweave.operators.tables import insert_new


def expand_pages(targets: DataFrame, last: str = "last_page") -> DataFrame:
    """A row for each page of ``targets(..., start_page, <last>)``; none where last is before start."""
    pages = F.when(F.col(last) >= F.col("start_page"), F.sequence("start_page", last)).otherwise(F.array().cast("array<int>"))
    return targets.withColumn("page", F.explode(pages))


def stop_pages(scans: DataFrame, empty_limit: int = 1, stale_limit: int | None = 2, max_pages: int = 200) -> DataFrame:
    """``scans(run_id, target_name, page, urls, end_confirmed)`` up to each target's stopping page.

    Adds new_urls, the run lengths of empty and of stale pages, and on the last page its
    termination_reason.  An empty page has no URL; a stale one has URLs, all seen on earlier pages of
    the target; a page with new URLs ends both runs, an empty page ends a run of stale ones.
    """
    if max_pages < 1 or empty_limit < 1 or (stale_limit is not None and stale_limit < 1):
        raise ValueError("limits must be 1 or more")
    key = ["run_id", "target_name"]
    first = (
        scans.select(*key, "page", F.explode(F.array_distinct("urls")).alias("url"))
        .groupBy(*key, "url").agg(F.min("page").alias("page"))
        .groupBy(*key, "page").agg(F.count("*").alias("new_urls"))
    )
    x = scans.join(first, [*key, "page"], "left").withColumn("new_urls", F.coalesce("new_urls", F.lit(0)))
    kind = F.when(F.size("urls") == 0, "empty").when(F.col("new_urls") == 0, "stale").otherwise("useful")
    upto = Window.partitionBy(*key).orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("page_kind", kind)
    x = x.withColumns({
        "_useful": F.sum(F.when(F.col("page_kind") != "empty", 1).otherwise(0)).over(upto),
        "_broken": F.sum(F.when(F.col("page_kind") != "stale", 1).otherwise(0)).over(upto),
        "_place": F.count("*").over(upto),
    })
    run = lambda flag, mark: F.sum(F.when(F.col("page_kind") == flag, 1).otherwise(0)).over(Window.partitionBy(*key, mark).orderBy("page").rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumns({"empty_run": run("empty", "_useful"), "stale_run": run("stale", "_broken")})
    stop = (
        F.when(F.col("empty_run") >= empty_limit, F.when(F.coalesce("end_confirmed", F.lit(False)), "confirmed_empty").otherwise("unconfirmed_empty"))
        .when(F.lit(stale_limit is not None) & (F.col("stale_run") >= (stale_limit or 0)), "stale_pages")
        .when(F.col("_place") >= max_pages, "max_page_limit")
    )
    x = x.withColumn("_stop", stop)
    earlier = Window.partitionBy(*key).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    kept = x.withColumn("_over", F.coalesce(F.max(F.col("_stop").isNotNull()).over(earlier), F.lit(False))).where("not _over")
    return kept.withColumnRenamed("_stop", "termination_reason").drop("_useful", "_broken", "_place", "_over")


def target_progress(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Counters of each target from its visited pages: found, new to the registry, repeated, empty, invalid.

    ``pages`` has run_id, target_name, page, urls and is_valid; ``known`` has the registry's urls.
    """
    key = ["run_id", "target_name"]
    base = pages.groupBy(*key).agg(
        F.count("*").alias("fetched_page_count"),
        F.count_if(F.col("is_valid") & (F.size("urls") == 0)).alias("empty_page_count"),
        F.count_if(~F.col("is_valid")).alias("invalid_page_count"),
        F.sum(F.when(F.size("urls") > 0, F.size("urls")).otherwise(0)).alias("_mentions"),
        F.max(F.when(F.size("urls") > 0, F.col("page"))).alias("last_useful_page"),
    )
    urls = pages.select(*key, F.explode("urls").alias("url")).distinct()
    counted = urls.join(known.select("url", F.lit(True).alias("_known")).distinct(), "url", "left").groupBy(*key).agg(
        F.count("*").alias("discovered_url_count"), F.count_if(F.col("_known").isNull()).alias("new_url_count")
    )
    zero = F.lit(0).cast("long")
    out = base.join(counted, key, "left").withColumns({c: F.coalesce(c, zero) for c in ("discovered_url_count", "new_url_count")})
    return out.withColumn("duplicate_url_count", F.col("_mentions") - F.col("discovered_url_count")).drop("_mentions")


def coverage_complete(status: Column, reason: Column, repeated: Column, invalid_pages: Column) -> Column:
    """Did a target show all its listings?  Only a known last page or a confirmed end say so."""
    return (status == "completed") & reason.isin("detected_last_page", "confirmed_empty") & ~repeated & (invalid_pages == 0)


def register(jobs: DataFrame, urls: DataFrame, run_id: int, at: Column) -> tuple[DataFrame, DataFrame]:
    """(next registry, new listings): new URLs join as pending, seen ones get the run and the time.

    A seen listing whose raw page was purged goes back to pending with a fresh budget of tries.
    """
    seen = urls.select("source", "url").distinct()
    fresh = seen.withColumns({"raw_status": F.lit("pending"), "listing_status": F.lit("unknown"), "first_seen_at": at, "fetch_attempt_count": F.lit(0)})
    base, new = insert_new(jobs, fresh, ["source", "url"])
    marked = base.join(seen.withColumn("_seen", F.lit(True)), ["source", "url"], "left")
    hit = F.coalesce("_seen", F.lit(False))
    purged = hit & F.coalesce(F.col("raw_status") == "storage_missing", F.lit(False))
    updates = {
        "last_seen_run_id": F.when(hit, F.lit(run_id).cast("long")).otherwise(F.col("last_seen_run_id")),
        "last_seen_at": F.when(hit, at).otherwise(F.col("last_seen_at")),
        "fetch_attempt_count": F.when(purged, 0).otherwise(F.col("fetch_attempt_count")),
        "raw_status": F.when(purged, "pending").otherwise(F.col("raw_status")),
    }
    return marked.withColumns({k: v for k, v in updates.items() if k in marked.columns}).select(*jobs.columns), new
