"""Closed vocabularies and schemas of the listing engine."""

from __future__ import annotations

# Fixed values, by column.
RUN_STATUS = ("running", "completed", "failed", "blocked", "suspicious")
PHASES = ("full", "discovery", "detail", "parse")
RAW_STATUS = ("pending", "fetching", "validating", "uploading", "raw_ready", "retryable_error", "blocked", "permanent_error", "storage_missing", "storage_corrupt")
FETCH_ERRORS = ("retryable_error", "permanent_error", "blocked", "storage_missing", "storage_corrupt")
FETCH_BUSY = ("fetching", "validating", "uploading")
PARSE_STATUS = ("parsing", "success", "parse_error", "validation_error", "raw_missing", "raw_corrupt")
LISTING_STATUS = ("unknown", "active", "expired")
CDC_STATUS = ("not_applicable", "pending", "baseline", "applied", "skipped")
QUALITY_STATUS = ("accepted", "partial", "rejected")
USABLE_QUALITY = ("accepted", "partial")
ENRICHMENT_STATUS = ("pending", "processing", "succeeded", "retry_wait", "failed", "superseded")
SENIORITY = ("intern", "fresher", "junior", "middle", "senior", "lead", "manager", "director")
WORK_MODES = ("onsite", "hybrid", "remote")
EMPLOYMENT_TYPES = ("full_time", "part_time", "internship", "contract", "temporary", "freelance")
EXPERIENCE_BUCKETS = ("zero", "under1", "1to3", "3to5", "5plus", "unknown")

#: Canonical record as extraction returns it.
RECORD = (
    "title string, employer_name_raw string, description_text string, requirements_text string, benefits_text string, "
    "domains_raw array<string>, categories_raw array<string>, skills_raw array<string>, benefit_items array<string>, "
    "locations_raw array<string>, source_external_job_id string, source_variant string, salary_raw string, "
    "employment_type_raw string, experience_raw string, posted_at string, expires_at string, source_payload string, "
    "issues array<struct<field:string,severity:string,code:string,message:string>>"
)
ISSUES = "array<struct<field:string,severity:string,code:string,message:string>>"
