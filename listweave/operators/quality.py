"""Quality of parsed records, acceptance of raw pages, and detection of block pages."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.functions.html import has_selector, visible_text
from listweave.vocabulary import ISSUES

# Fields that count for the score, and those that are asked for but not required.
SCORED = ("title", "employer_name_raw", "description_text", "requirements_text", "benefits_text", "domains_raw", "categories_raw", "skills_raw")
RECOMMENDED = SCORED[2:]
LISTS = ("domains_raw", "categories_raw", "skills_raw", "benefit_items", "locations_raw")
COUNTED = SCORED + ("benefit_items", "locations_raw", "source_external_job_id", "source_variant", "salary_raw", "employment_type_raw", "experience_raw", "posted_at", "expires_at")


def present(name: str) -> Column:
    """A list with items or a text that is not empty."""
    if name in LISTS:
        return F.coalesce(F.size(name), F.lit(0)) > 0
    return F.coalesce(F.col(name).cast("string"), F.lit("")) != ""


def _named(conditions: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in conditions]))


def assess(records: DataFrame) -> DataFrame:
    """Quality of canonical records: status, score, what is missing, and all issues.

    Rejected: title, employer or all content is missing, or an issue is an error.  Partial: a
    recommended field is missing or an issue is a warning.  Else accepted.  The score is the share of
    eight fields in percent, halves to even.
    """
    issues = F.coalesce(F.col("issues").cast(ISSUES), F.array().cast(ISSUES)) if "issues" in records.columns else F.array().cast(ISSUES)
    content = present("description_text") | present("requirements_text")
    required = _named([(~present("title"), "title"), (~present("employer_name_raw"), "employer_name_raw"), (~content, "job_content")])
    recommended = _named([(~present(f), f) for f in RECOMMENDED])
    found = records.withColumns({"_issues": issues, "missing_required_fields": required, "missing_recommended_fields": recommended})

    def said(severity: str) -> Column:
        return F.transform(F.filter("_issues", lambda i: i["severity"] == severity), lambda i: i["field"])

    def added(names: str, severity: str, code: str, words: str) -> Column:
        new = F.filter(F.col(names), lambda n: ~F.coalesce(F.array_contains(said(severity), n), F.lit(False)))
        return F.transform(new, lambda n: F.struct(
            n.alias("field"), F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.concat(F.lit(words), n).alias("message")
        )).cast(ISSUES)

    everything = F.concat(
        F.col("_issues"),
        added("missing_required_fields", "error", "missing_required_field", "Required field is missing: "),
        added("missing_recommended_fields", "warning", "missing_recommended_field", "Recommended field is missing: "),
    )
    score = sum((F.when(present(f), 1).otherwise(0) for f in SCORED), F.lit(0))
    counted = sum((F.when(present(f), 1).otherwise(0) for f in COUNTED if f in records.columns), F.lit(0))
    has = lambda s: F.exists("_all", lambda i: i["severity"] == s)
    return (
        found.withColumn("_all", everything)
        .withColumn("quality_status", F.when(has("error"), "rejected").when(has("warning"), "partial").otherwise("accepted"))
        .withColumn("completeness_score", F.bround(F.lit(100.0) * score / len(SCORED)).cast("int"))
        .withColumn("parsed_field_count", counted.cast("int"))
        .drop("_issues", "issues")
        .withColumnRenamed("_all", "issues")
    )


# Marks of block pages, in lower case, and what they mean.
CHALLENGE_TITLE = "<title>just a moment"
CHALLENGE_FORM = ("id=\"challenge-form\"", "id='challenge-form'")
CHALLENGE_FIELD, CHALLENGE_HOST = "cf-chl-", "challenges.cloudflare.com"
CAPTCHA_MARKS = ("<title>captcha", "<title>verify", "verify you are human", "xác minh bạn là con người")
RATE_MARKS = ("too many requests", "rate limit exceeded")


def block_reason(html: Column | str, status: Column | str) -> Column:
    """Why a page is a block page and no content, or null.

    A page that merely loads a challenge script is not blocked; a challenge needs its title, its form
    with its data, or a refusing status.  The whole page is searched.
    """
    page = F.lower(F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit("")))
    code = F.col(status) if isinstance(status, str) else status

    def has(*marks: str) -> Column:
        return functools.reduce(lambda a, b: a | b, [F.contains(page, F.lit(m)) for m in marks])

    refused = F.coalesce(code.isin(403, 503), F.lit(False))
    challenge = has(CHALLENGE_TITLE) | (has(CHALLENGE_FIELD) & has(*CHALLENGE_FORM)) | (refused & has(CHALLENGE_HOST))
    return (
        F.when(challenge, "Cloudflare challenge")
        .when(has(*CAPTCHA_MARKS), "CAPTCHA challenge")
        .when(has(*RATE_MARKS), "rate-limit page")
        .when(code == 403, "HTTP 403 access denied")
    )


@dataclass(frozen=True)
class Acceptance:
    """What a raw page must show."""

    min_bytes: int = 1
    min_text_chars: int = 1
    allowed_hosts: tuple[str, ...] = ()
    path_prefixes: tuple[str, ...] = ()
    required_selectors: tuple[str, ...] = ()
    optional_selectors: tuple[str, ...] = ()
    version: str = "v1"


def host_of(url: Column | str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def path_of(url: Column | str) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def accept_pages(pages: DataFrame, rules: Acceptance) -> DataFrame:
    """``pages(html, url, final_url, http_status, content_type)`` with errors, warnings, is_valid and metrics.

    Only the visible text and selectors are computed in Python, over Arrow batches, and only if asked.
    """
    page = F.coalesce(F.col("html"), F.lit(""))
    size = F.octet_length(page)
    base = pages.withColumn("_reason", block_reason("html", "http_status")).withColumn("_text_chars", F.length(visible_text(page)))
    hosts = F.array(*[F.lit(h.lower()) for h in rules.allowed_hosts]) if rules.allowed_hosts else F.array(host_of("url"))
    checks = [
        (~F.col("http_status").eqNullSafe(F.lit(200)), F.lit("unexpected_http_status")),
        ((F.coalesce(F.col("content_type"), F.lit("")) != "") & ~F.contains(F.lower("content_type"), F.lit("text/html")), F.lit("unexpected_content_type")),
        (F.trim(page) == "", F.lit("empty_html")),
        (size < rules.min_bytes, F.lit("html_too_small")),
        (F.col("_reason").isNotNull(), F.concat(F.lit("blocked:"), F.replace(F.lower("_reason"), F.lit(" "), F.lit("_")))),
        (~F.array_contains(hosts, host_of("final_url")), F.lit("unexpected_final_host")),
    ]
    if rules.path_prefixes:
        starts = [F.startswith(path_of("final_url"), F.lit(p)) for p in rules.path_prefixes]
        checks.append((~functools.reduce(lambda a, b: a | b, starts), F.lit("unexpected_final_path")))
    checks.append((F.col("_text_chars") < rules.min_text_chars, F.lit("visible_text_too_short")))
    checks += [(~has_selector(page, s), F.lit(f"missing_required_selector:{s}")) for s in rules.required_selectors]
    warnings = [(~has_selector(page, s), F.lit(f"missing_optional_selector:{s}")) for s in rules.optional_selectors]
    listed = lambda pairs: F.array_compact(F.array(*[F.when(c, n) for c, n in pairs])) if pairs else F.array().cast("array<string>")
    out = base.withColumns({"errors": listed(checks), "warnings": listed(warnings)})
    return out.withColumns({
        "is_valid": F.size("errors") == 0,
        "validation_version": F.lit(rules.version),
        "metrics": F.struct(size.alias("html_bytes"), F.col("_text_chars").alias("visible_text_chars"), F.lit(len(rules.required_selectors)).alias("required_selector_count"), host_of("final_url").alias("final_host")),
    }).drop("_reason", "_text_chars")


def identity_errors(pages: DataFrame, pattern: str) -> DataFrame:
    """Pages whose requested, final and canonical URLs name different listings, with the reason.

    ``pattern`` has one group, the listing's identity within a URL's path.
    """
    ident = lambda c: F.nullif(F.regexp_extract(path_of(c), pattern, 1), F.lit(""))
    wanted = ident("url")
    error = (
        F.when(wanted.isNull(), "no_identity_in_url")
        .when(~wanted.eqNullSafe(ident("final_url")), "final_url_of_another_listing")
        .when(F.col("canonical_url").isNotNull() & ~wanted.eqNullSafe(ident("canonical_url")), "canonical_url_of_another_listing")
    )
    return pages.withColumn("identity_error", error).where("identity_error is not null")
