"""The enrichment queue: candidates, enqueueing, quotas, token estimates, packing, validation, backfill."""

from __future__ import annotations

import json
import math
from collections import deque
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone
from typing import Any
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listweave.functions.dates import HOME_ZONE
from listweave.functions.text import quote_in_any
from listweave.shipping import ship
from listweave.vocabulary import EMPLOYMENT_TYPES, SENIORITY, USABLE_QUALITY, WORK_MODES

VERSION = "v1"
# Input and result fields.
INPUT_FIELDS = ("title", "description_text", "requirements_text", "benefits_text", "skills_raw", "experience_raw", "employment_type_raw")
RESULT_FIELDS = ("skills_required", "skills_preferred", "experience_min_years", "experience_max_years", "seniority_levels", "work_mode", "employment_type")
ARRAY_FIELDS = ("skills_required", "skills_preferred", "seniority_levels")
ENUMS = {"seniority_levels": SENIORITY, "work_mode": WORK_MODES, "employment_type": EMPLOYMENT_TYPES}
RESULT_SCHEMA = (
    "skills_required array<string>, skills_preferred array<string>, experience_min_years double, experience_max_years double, "
    "seniority_levels array<string>, work_mode string, employment_type string, evidence struct<" + ", ".join(f"{f}: array<string>" for f in RESULT_FIELDS) + ">"
)
#: Tokens a byte until usage is known; samples needed, head room and floor once it is.
FIRST_RATIO, MIN_SAMPLES, HEADROOM, FLOOR, SAMPLES = 0.5, 20, 1.25, 0.25, 100
RETRY_MINUTES = 15
#: Spans of rolling sums and the slices they are summed in, in microseconds.
DAY, MINUTE, SLICE = 86_400_000_000, 60_000_000, 900_000_000


def input_hash() -> Column:
    """Hash of what the model would read; nulls count."""
    return F.sha2(F.to_json(F.struct(*INPUT_FIELDS), {"ignoreNullFields": "false"}), 256)


def candidates(results: DataFrame, postings: DataFrame, jobs: DataFrame, eligible_from: Column) -> DataFrame:
    """Current usable results of active listings fetched since ``eligible_from`` whose content the posting
    did not already have before; so old listings that are fetched anew unchanged are no backlog."""
    hashed = results.withColumn("input_hash", input_hash())
    p = postings.select(F.col("id").alias("source_posting_id"), F.col("crawler_job_id").alias("job_id"))
    active = jobs.where("listing_status = 'active'").select(F.col("id").alias("job_id"))
    now = hashed.where(F.col("is_current") & F.col("quality_status").isin(*USABLE_QUALITY) & (F.col("fetched_at") >= eligible_from))
    before = hashed.where(F.col("fetched_at") < eligible_from).select("source_posting_id", "input_hash").distinct()
    x = now.join(p, "source_posting_id").join(active, "job_id", "left_semi").join(before, ["source_posting_id", "input_hash"], "left_anti")
    return x.select(F.col("id").alias("parse_result_id"), "source_posting_id", "input_hash", *INPUT_FIELDS)


def enqueue(queue: DataFrame, found: DataFrame, current: DataFrame, at: Column) -> DataFrame:
    """Next queue: interrupted work waits again, stale waiting work is superseded, returning content is
    pending again, and new content joins once."""
    key = ["source_posting_id", "input_hash"]
    here = current.select(*key).distinct().withColumn("_here", F.lit(True))
    back = found.select(*key).distinct().withColumn("_back", F.lit(True))
    x = queue.join(here, key, "left").join(back, key, "left")
    status = F.when(F.col("status") == "processing", "retry_wait").otherwise(F.col("status"))
    dropped = status.isin("pending", "retry_wait") & F.col("_here").isNull()
    after = F.when(dropped, "superseded").otherwise(status)
    versioned = (F.col("schema_version") == VERSION) & (F.col("prompt_version") == VERSION)
    final = F.when((after == "superseded") & F.col("_back").isNotNull() & versioned, "pending").otherwise(after)
    changed = ~final.eqNullSafe(F.col("status"))
    old = x.select(
        *[F.when(F.col("status") == "processing", "interrupted").otherwise(F.col("error_code")).alias("error_code") if c == "error_code"
          else F.when(F.col("status") == "processing", at).otherwise(F.col(c)).alias(c) if c == "next_attempt_at"
          else F.when(changed, at).otherwise(F.col(c)).alias(c) if c == "updated_at"
          else final.alias("status") if c == "status" else F.col(c) for c in queue.columns]
    )
    known = queue.where(versioned).select(*key)
    new = found.select(*key, "parse_result_id").dropDuplicates(key).join(known, key, "left_anti").withColumns({
        "schema_version": F.lit(VERSION), "prompt_version": F.lit(VERSION), "status": F.lit("pending"), "attempts": F.lit(0), "next_attempt_at": at, "created_at": at, "updated_at": at,
    })
    return old.unionByName(new.select(*[c for c in new.columns if c in queue.columns]), allowMissingColumns=True)


def due_jobs(queue: DataFrame, found: DataFrame, at: Column, max_attempts: int, order: str = "next_attempt_at", fresh_only: bool = False) -> DataFrame:
    """Waiting jobs whose content is still wanted, due, with tries left, in dispatch order."""
    x = queue.where(F.col("status").isin("pending", "retry_wait") & (F.col("next_attempt_at") <= at) & (F.col("attempts") < max_attempts))
    x = x.where((F.col("schema_version") == VERSION) & (F.col("prompt_version") == VERSION))
    if fresh_only:
        x = x.where("attempts = 0")
    extra = ["priority"] if order == "priority" else []
    x = x.join(found.select("source_posting_id", "input_hash", *extra).distinct(), ["source_posting_id", "input_hash"])
    return x.orderBy(order, "id")


def fail_exhausted(queue: DataFrame, max_attempts: int) -> DataFrame:
    over = F.col("status").isin("pending", "retry_wait") & (F.col("attempts") >= max_attempts)
    return queue.withColumn("status", F.when(over, "failed").otherwise(F.col("status")))


def token_ratio(attempts: DataFrame, at: Column) -> DataFrame:
    """Tokens a byte by provider, model and kind of request, from the last hundred known usages.

    The 95th percentile with head room, no less than the floor; with under twenty samples a fixed ratio.
    """
    usable = attempts.where((F.col("input_bytes") > 0) & (F.col("input_tokens") > 0) & (F.col("started_at") > at - F.make_dt_interval(days=F.lit(30))))
    batch = (F.col("item_count") > 1).alias("batch")
    order = Window.partitionBy("provider", "model", "batch").orderBy(F.desc("started_at"), F.desc("id"))
    last = usable.select("provider", "model", batch, "started_at", "id", (F.col("input_tokens") / F.col("input_bytes")).alias("ratio")).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= SAMPLES)
    out = last.groupBy("provider", "model", "batch").agg(F.count("*").alias("samples"), F.percentile("ratio", F.lit(0.95)).alias("_p95"))
    return out.withColumn("ratio", F.when(F.col("samples") < MIN_SAMPLES, F.lit(FIRST_RATIO)).otherwise(F.greatest(F.lit(FLOOR), F.col("_p95") * HEADROOM))).drop("_p95")


def usage(attempts: DataFrame, at: Column) -> DataFrame:
    """Requests and tokens of each provider over the last day and minute; unknown usage counts as reserved."""
    spent = F.coalesce("actual_tokens", "reserved_tokens")
    minute = F.col("started_at") > at - F.make_dt_interval(secs=F.lit(60))
    return attempts.where(F.col("started_at") > at - F.make_dt_interval(hours=F.lit(24))).groupBy("provider").agg(
        F.count("*").alias("requests_day"), F.coalesce(F.sum(spent), F.lit(0)).alias("tokens_day"),
        F.count_if(minute).alias("requests_minute"), F.coalesce(F.sum(F.when(minute, spent)), F.lit(0)).alias("tokens_minute"),
    )


def admission(providers: DataFrame, attempts: DataFrame, blocks: DataFrame, at: Column, tokens: int) -> DataFrame:
    """May a request of ``tokens`` go to each provider now, and if not, why?  A cooldown goes before all.

    Providers: provider, requests_per_day, tokens_per_day, requests_per_minute, tokens_per_minute,
    enforce_daily_budget.
    """
    x = providers.join(usage(attempts, at), "provider", "left").join(blocks.select("provider", "blocked_until"), "provider", "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    daily = F.coalesce("enforce_daily_budget", F.lit(True))
    why = (
        F.when(F.coalesce(F.col("blocked_until") > at, F.lit(False)), "cooldown")
        .when(daily & (n("requests_day") >= F.col("requests_per_day")), "requests_per_day")
        .when(daily & (n("tokens_day") + tokens > F.col("tokens_per_day")), "tokens_per_day")
        .when(n("requests_minute") >= F.col("requests_per_minute"), "requests_per_minute")
        .when(n("tokens_minute") + tokens > F.col("tokens_per_minute"), "tokens_per_minute")
    )
    return x.withColumns({"refusal": why, "admitted": why.isNull()})


def rolling_usage(attempts: DataFrame) -> DataFrame:
    """Each attempt with the tokens and requests of its provider in the day and minute up to it.

    An attempt adds to both sums when it starts and takes from each when it leaves it.  These steps are
    summed in slices of time, a task a provider and slice, on top of what the slices before amount to,
    so that no task holds a provider's whole ledger.  An attempt without a start counts for nothing.
    """
    sums = ("tokens_day", "requests_day", "tokens_minute", "requests_minute")
    kinds = [f"struct<{', '.join(f'{s}:bigint' for s in sums)}>"]
    spent = F.coalesce("actual_tokens", "reserved_tokens").cast("long")
    tokens, nothing, one = F.coalesce(spent, F.lit(0)), F.lit(0), F.lit(1)
    steps = ((0, (tokens, one, tokens, one)), (DAY, (-tokens, -one, nothing, nothing)), (MINUTE, (nothing, nothing, -tokens, -one)))
    start = F.unix_micros(F.col("started_at").cast("timestamp"))
    row = F.struct(*[F.col(c) for c in attempts.columns])
    moved = F.array(*[
        F.struct((start + after).alias("_at"), F.struct(*[v.cast("long").alias(n) for n, v in zip(sums, change, strict=True)]).cast(kinds[0]).alias("_by"), F.when(F.lit(after == 0), row).alias("_row"))
        for after, change in steps
    ])
    events = attempts.select(F.col("provider").alias("_who"), F.explode(moved).alias("_e")).select("_who", "_e.*").withColumn("_slice", F.floor(F.col("_at") / SLICE))
    slices = events.groupBy("_who", "_slice").agg(*[F.sum(f"_by.{s}").alias(s) for s in sums])
    ahead = Window.partitionBy("_who").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    held = slices.select(F.col("_who").alias("_w"), F.col("_slice").alias("_s"), *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(f"_{s}") for s in sums])
    placed = events.join(held, F.col("_who").eqNullSafe(F.col("_w")) & F.col("_slice").eqNullSafe(F.col("_s")))
    here = Window.partitionBy("_who", "_slice").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    out = placed.withColumns({s: F.col(f"_{s}") + F.sum(f"_by.{s}").over(here) for s in sums}).where("_row is not null")
    return out.select("_row.*", *sums)


def request_status(members: DataFrame) -> DataFrame:
    """Status and error of each request from its members: what all share, else ``partial``."""
    out = members.groupBy("attempt_id").agg(
        F.count_distinct("status").alias("_s"), F.first("status").alias("_status"), F.count_distinct("error_code").alias("_e"), F.max("error_code").alias("_error")
    )
    return out.select(
        "attempt_id", F.when(F.col("_s") == 1, F.col("_status")).otherwise("partial").alias("status"),
        F.when(F.col("_e") == 1, F.col("_error")).when(F.col("_e") > 1, "partial_failure").alias("error_code"),
    )


def finish(queue: DataFrame, outcomes: DataFrame, at: Column, max_attempts: int) -> DataFrame:
    """Queue after ``outcomes(id, result, error)``: succeeded, failed for good, or waiting to retry."""
    o = outcomes.select("id", F.col("result").alias("_result"), F.col("error").alias("_error"), F.lit(True).alias("_hit"))
    x = queue.join(o, "id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    status = F.when(F.col("_error").isNull(), "succeeded").when(F.coalesce("attempts", F.lit(0)) >= max_attempts, "failed").otherwise("retry_wait")
    new = {"status": status, "result": F.col("_result"), "error_code": F.col("_error"), "next_attempt_at": at + F.make_dt_interval(mins=F.lit(RETRY_MINUTES)), "updated_at": at}
    return x.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in queue.columns])


# -- packing ---------------------------------------------------------------------------------------


def estimate(n_bytes: Column, ratio: float, output: int) -> Column:
    """Tokens of a request: its bytes by the ratio, rounded up, and all of its output."""
    return (F.ceil(n_bytes * F.lit(float(ratio))) + F.lit(output)).cast("long")


@dataclass(frozen=True)
class Packing:
    size: int = 3
    overhead_bytes: int = 0
    ratio: float = FIRST_RATIO
    output_per_job: int = 1000
    max_input_tokens: int = 12_000
    max_request_tokens: int = 1_000_000_000


def pack(sizes: list[tuple[Any, int, int]], p: Packing) -> list[list[Any]]:
    """Requests from (id, bytes, attempts) in dispatch order: the head takes followers while they fit.

    A head that was tried before goes alone; only untried jobs follow; the first that does not fit ends
    the request.
    """
    # untried jobs are taken in order, by heads as by followers, so one queue of them serves both
    fresh, out, taken = deque(i for i, job in enumerate(sizes) if not job[2]), [], 0
    for place, (name, held, attempts) in enumerate(sizes):
        if not attempts and place < taken:
            continue
        group = [name]
        if not attempts:
            fresh.popleft()
            while fresh and len(group) < p.size:
                follower, size, _ = sizes[fresh[0]]
                read = math.ceil((p.overhead_bytes + held + size) * p.ratio)
                if read > p.max_input_tokens or read + p.output_per_job * (len(group) + 1) > p.max_request_tokens:
                    break
                group.append(follower)
                held += size
                fresh.popleft()
            taken = fresh[0] if fresh else len(sizes)
        out.append(group)
    return out


def pack_requests(jobs: DataFrame, p: Packing, by: str = "provider") -> DataFrame:
    """(by, request, id, place): jobs(by, id, input_bytes, attempts, priority) packed in order of priority.

    Packing is sequential, so each provider is packed by one task; the caller bounds what it selects.
    """
    ship(jobs.sparkSession)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["priority", "id"])
        groups = pack(list(zip(frame["id"], frame["input_bytes"], frame["attempts"], strict=True)), p)
        rows = [(frame[by].iloc[0], n, i, k) for n, g in enumerate(groups) for k, i in enumerate(g)]
        return pd.DataFrame(rows, columns=[by, "request", "id", "place"])

    kind = jobs.schema[by].dataType.simpleString()
    return jobs.select(by, "id", "input_bytes", "attempts", "priority").groupBy(by).applyInPandas(run, f"{by} {kind}, request int, id long, place int")


# -- validation ------------------------------------------------------------------------------------


def _not_in(allowed: tuple[str, ...]):
    return lambda v: ~v.isin(*allowed)


def validation_error(texts: Column) -> Column:
    """First error of an extraction result (columns of RESULT_SCHEMA) against its input texts, or null.

    Field by field: evidence must be short quotes found in the input; a null value needs none, any other
    at least one; values must be of their kind and range.  Then ranges and conflicts across fields.
    """
    checks: list[tuple[Column, str]] = []
    for name in RESULT_FIELDS:
        value, quotes = F.col(name), F.col(f"evidence.{name}")
        bad = lambda q: q.isNull() | (F.trim(q) == "") | (F.length(q) > 2000)
        checks += [
            (quotes.isNull() | (F.size(quotes) > 40), "invalid_evidence"),
            (F.exists(quotes, bad), "invalid_quote"),
            (F.exists(quotes, lambda q: ~quote_in_any(texts, q)), "unsupported_evidence"),
            (value.isNull() & (F.size(quotes) > 0), "evidence_for_null"),
            (value.isNotNull() & (F.size(quotes) == 0), "missing_evidence"),
        ]
        if name in ARRAY_FIELDS:
            low = F.transform(value, lambda v: F.lower(F.trim(v)))
            checks += [
                (~F.size(value).between(1, 40), "invalid_array"),
                (F.exists(value, lambda v: v.isNull() | (F.trim(v) == "") | (F.length(v) > 120)), "invalid_array_item"),
                (F.size(F.array_distinct(low)) != F.size(value), "duplicate_values"),
            ]
            if name in ENUMS:
                checks.append((F.exists(value, _not_in(ENUMS[name])), "invalid_enum"))
        elif name in ENUMS:
            checks.append((~value.isin(*ENUMS[name]), "invalid_enum"))
        else:
            checks.append((F.isnan(value) | ~value.between(0, 60), "invalid_experience"))
    lower = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), F.lower)
    checks += [
        (F.col("experience_min_years") > F.col("experience_max_years"), "reversed_experience"),
        (F.arrays_overlap(lower("skills_required"), lower("skills_preferred")), "conflicting_skills"),
    ]
    out = F.lit(None).cast("string")
    for cond, code in reversed(checks):
        out = F.when(F.coalesce(cond, F.lit(False)), code).otherwise(out)
    return out


def batch_outcomes(expected: DataFrame, answers: DataFrame) -> DataFrame:
    """(request, job_id, error) of a batch: answers are matched by id, never by place.

    An answer for a job that was not asked fails the whole request; missing and repeated answers fail
    their job.
    """
    counts = answers.groupBy("request", "job_id").agg(F.count("*").alias("_n"))
    strangers = counts.join(expected.select("request", "job_id"), ["request", "job_id"], "left_anti").select("request").distinct().withColumn("_strange", F.lit(True))
    x = expected.select("request", "job_id").join(counts, ["request", "job_id"], "left").join(strangers, "request", "left")
    error = F.when(F.col("_strange"), "unknown_batch_job").when(F.col("_n").isNull(), "missing_batch_job").when(F.col("_n") > 1, "duplicate_batch_job")
    return x.select("request", "job_id", error.alias("error"))


# -- backfill --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Backfill:
    """Selection of old listings; checked and completed by ``resolved``."""

    lookback_days: int = 30
    max_jobs: int = 50
    date_field: str = "first_seen_at"
    sort_order: str = "newest_first"
    date_from: str | None = None
    date_to: str | None = None
    as_of: str | None = None
    sources: tuple[str, ...] = ()
    posting_ids: tuple[int, ...] = ()

    def resolved(self, now: datetime | None = None) -> "Backfill":
        """With all dates set; a half-open window that ends at ``as_of`` at the latest."""
        zone = ZoneInfo(HOME_ZONE)
        if not (1 <= self.lookback_days <= 36_500 and 1 <= self.max_jobs <= 1000):
            raise ValueError("lookback_days or max_jobs is out of range")
        if self.date_field not in ("first_seen_at", "posted_at", "fetched_at") or self.sort_order not in ("newest_first", "oldest_first"):
            raise ValueError("date_field or sort_order is unknown")
        if len(self.sources) > 100 or len(self.posting_ids) > 1000 or any(i < 1 for i in self.posting_ids):
            raise ValueError("too many sources or postings")

        def moment(text: str) -> datetime:
            t = datetime.fromisoformat(text)
            return t if t.tzinfo else t.replace(tzinfo=zone)

        anchor = moment(self.as_of) if self.as_of else (now or datetime.now(timezone.utc)).astimezone(zone)
        end = moment(self.date_to) if self.date_to else anchor
        start = moment(self.date_from) if self.date_from else end - timedelta(days=self.lookback_days)
        if not start < end <= anchor:
            raise ValueError("the window must begin before it ends, and end by as_of")
        return replace(self, as_of=anchor.isoformat(), date_from=start.isoformat(), date_to=end.isoformat(), sources=tuple(sorted(set(self.sources))), posting_ids=tuple(sorted(set(self.posting_ids))))


def backfill_bucket(max_attempts: int) -> Column:
    return (
        F.when(F.col("selection_date").isNull(), "missing_date")
        .when(F.col("status") == "succeeded", "succeeded")
        .when((F.col("status") == "failed") | (F.col("attempts") >= max_attempts), "failed_or_exhausted")
        .when(F.col("status") == "processing", "processing")
        .when(F.col("due"), "ready")
        .otherwise("retry_later")
    )


BUCKETS = ("missing_date", "succeeded", "failed_or_exhausted", "processing", "ready", "retry_later")


def backfill_rows(content: DataFrame, queue: DataFrame, date_field: str, start: Column, end: Column, at: Column, max_attempts: int, sources: tuple = (), posting_ids: tuple = ()) -> DataFrame:
    """Current content in the window (or without a date) with its bucket."""
    e = queue.where((F.col("schema_version") == VERSION) & (F.col("prompt_version") == VERSION)).select(
        "source_posting_id", "input_hash", F.col("id").alias("enrichment_id"), "status", "attempts", "next_attempt_at"
    )
    x = content.join(e, ["source_posting_id", "input_hash"], "left").withColumn("selection_date", F.col(date_field))
    if sources:
        x = x.where(F.col("source").isin(*sources))
    if posting_ids:
        x = x.where(F.col("source_posting_id").isin(*posting_ids))
    x = x.where(F.col("selection_date").isNull() | ((F.col("selection_date") >= start) & (F.col("selection_date") < end)))
    x = x.withColumns({"attempts": F.coalesce("attempts", F.lit(0)), "due": F.col("enrichment_id").isNull() | (F.col("next_attempt_at") <= at)})
    return x.withColumn("bucket", backfill_bucket(max_attempts))


def backfill_selection(rows: DataFrame, max_jobs: int, newest: bool = True) -> DataFrame:
    """The ready rows to enrich, in order, with their priority from 0."""
    d, i = F.col("selection_date"), F.col("source_posting_id")
    order = [d.desc_nulls_last(), i.desc()] if newest else [d.asc_nulls_last(), i.asc()]
    top = rows.where("bucket = 'ready'").orderBy(*order).limit(max_jobs)
    # at most max_jobs rows are numbered in one place
    return top.withColumn("priority", F.row_number().over(Window.orderBy(*order)) - 1)


def backfill_counts(rows: DataFrame) -> DataFrame:
    """Rows by source and bucket with explicit zeros; rows without a date are counted, not matched."""
    grid = rows.select("source").distinct().withColumn("bucket", F.explode(F.array(*[F.lit(b) for b in BUCKETS])))
    counts = rows.groupBy("source", "bucket").agg(F.count("*").alias("jobs"))
    return grid.join(counts, ["source", "bucket"], "left").withColumn("jobs", F.coalesce("jobs", F.lit(0).cast("long")))


def round_robin_sample(rows: DataFrame, per: str, key: str, n: int) -> DataFrame:
    """``n`` rows taken from each ``per`` group in turn, in the order of the key's md5."""
    mix = F.md5(F.col(key).cast("string").cast("binary"))
    place = F.row_number().over(Window.partitionBy(per).orderBy(mix, key))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).orderBy("_place", per).limit(n).drop("_place")


def compare_arms(single: DataFrame, batch: DataFrame, fields: tuple[str, ...] = RESULT_FIELDS) -> DataFrame:
    """Share of ids on which two arms agree, by field; arrays compare as sets."""
    def form(side: str, f: str) -> Column:
        c = F.col(f"{side}.{f}")
        return F.array_sort(F.transform(c, F.lower)) if f in ARRAY_FIELDS else c

    joined = single.alias("s").join(batch.alias("b"), F.col("s.id") == F.col("b.id"))
    return joined.agg(F.count("*").alias("compared"), *[F.avg(form("s", f).eqNullSafe(form("b", f)).cast("double")).alias(f) for f in fields])


def result_from_json(text: Column) -> Column:
    return F.from_json(text, RESULT_SCHEMA)


def canonical_input(payload: dict) -> str:
    return json.dumps(payload, ensure_ascii=False, sort_keys=True)


def current_enrichments(results: DataFrame, queue: DataFrame) -> DataFrame:
    """The enrichment of each current result: the same posting and content, this version."""
    own = queue.where((F.col("schema_version") == VERSION) & (F.col("prompt_version") == VERSION)).select(
        "source_posting_id", "input_hash", "status", "result", F.col("updated_at").alias("enriched_at")
    )
    now = results.where("is_current").select(F.col("id").alias("parse_result_id"), "source_posting_id", "input_hash")
    return now.join(own, ["source_posting_id", "input_hash"]).select("parse_result_id", "status", "result", "enriched_at")


def skills_of_result(result: Column, name: str) -> Column:
    """A skill list of a result in JSON; empty if it is missing, null or no array of texts."""
    got = F.try_variant_get(F.try_parse_json(result), f"$.{name}", "array<string>")
    return F.coalesce(got, F.array().cast("array<string>"))


def adaptive(results: DataFrame, enriched: DataFrame | None) -> DataFrame:
    """Results with enrichment columns, all null where there is no enrichment at all."""
    columns = {"enrichment_status": "status", "enrichment_result": "result", "enriched_at": "enriched_at"}
    if enriched is None:
        kinds = {"enriched_at": "timestamp_ntz"}
        return results.withColumns({c: F.lit(None).cast(kinds.get(c, "string")) for c in columns})
    e = enriched.select(F.col("parse_result_id").alias("id"), *[F.col(s).alias(c) for c, s in columns.items()])
    return results.join(e, "id", "left").withColumn("enrichment_status", F.coalesce("enrichment_status", F.lit("not_enriched")))
