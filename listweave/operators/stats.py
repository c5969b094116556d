"""Facet statistics over the rows that a search matches, in one pass over them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listweave.operators.search import Filters, experience_bucket, matching, skill_keys
from listweave.operators.skills import DEFAULT_CATALOGUE

TOP_SKILLS = 15


def _fact(kind: str, key: Column, label: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), (key if label is None else label).cast("string").alias("label"))


def facts(base: DataFrame, scope: str, catalogue=DEFAULT_CATALOGUE) -> DataFrame:
    """A row for each facet value of each row; values are distinct per row, so counts are counts of rows.

    A row without a city counts under a null city; one without levels or mode under ``unknown``.
    """
    labels = F.create_map(*[F.lit(x) for r in catalogue for x in (r["key"], r["label"])])
    cities = F.array_distinct(F.filter(F.coalesce("location_cities", F.array().cast("array<string>")), lambda c: F.trim(c) != ""))
    places = F.when(F.size(cities) > 0, cities).otherwise(F.array(F.lit(None).cast("string")))
    levels = F.when(F.size("levels") > 0, F.array_distinct("levels")).otherwise(F.array(F.lit("unknown")))
    known = F.filter(F.array_distinct(skill_keys(scope)), lambda k: F.map_contains_key(labels, k))
    everything = F.concat(
        F.array(_fact("source", F.col("source_code"), F.col("source_name"))),
        F.transform(places, lambda c: _fact("city", c)),
        F.transform(known, lambda k: _fact("skill", k, F.element_at(labels, k))),
        F.transform(levels, lambda v: _fact("seniority", v)),
        F.array(_fact("mode", F.coalesce("mode", F.lit("unknown"))), _fact("experience", experience_bucket(F.col("exp")))),
    )
    return base.select(F.explode(everything).alias("f")).select("f.*")


def facet_counts(base: DataFrame, scope: str, catalogue=DEFAULT_CATALOGUE) -> DataFrame:
    """(kind, key, label, count, pos): positions by count, then label; of skills the first fifteen."""
    counts = facts(base, scope, catalogue).groupBy("kind", "key", "label").agg(F.count("*").cast("int").alias("count"))
    order = Window.partitionBy("kind").orderBy(F.desc("count"), F.asc_nulls_last("label"), F.asc_nulls_last("key"))
    return counts.withColumn("pos", F.row_number().over(order)).where((F.col("kind") != "skill") | (F.col("pos") <= TOP_SKILLS))


def coverage(base: DataFrame, scope: str) -> DataFrame:
    """Totals of the matched rows: enriched, with skills as extracted and as normalised, and so on."""
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    wide = lambda a, b: some(a) | some(b) if scope == "all" else some(a)
    done = F.coalesce(F.col("enrichment_status") == "succeeded", F.lit(False))
    return base.agg(
        F.count("*").alias("total"),
        F.count_if(done).alias("enriched"),
        F.count_if(done & wide("skills_required", "skills_preferred")).alias("extracted"),
        F.count_if(wide("required_skill_keys", "preferred_skill_keys")).alias("normalized"),
        F.count("exp").alias("experience"),
        F.count_if(some("levels")).alias("seniority"),
        F.count("mode").alias("mode"),
    )


def statistics(jobs: DataFrame, f: Filters, as_of: datetime, catalogue=DEFAULT_CATALOGUE) -> dict[str, DataFrame]:
    base, _ = matching(jobs, f, as_of)
    return {"rows": facet_counts(base, f.skill_scope, catalogue), "coverage": coverage(base, f.skill_scope)}


def statistics_json(jobs: DataFrame, f: Filters, as_of: datetime, catalogue=DEFAULT_CATALOGUE) -> DataFrame:
    """One row: the statistics as JSON, facets in order of kind and position."""
    s = statistics(jobs, f, as_of, catalogue)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("kind", "pos", "key", "label", "count"))), lambda r: F.struct(r["kind"].alias("kind"), r["key"].alias("key"), r["label"].alias("label"), r["count"].alias("count")))
    rows = s["rows"].agg(ordered.alias("rows"))
    whole = rows.join(s["coverage"].select("total", F.struct("enriched", "extracted", "normalized", "experience", "seniority", "mode").alias("coverage")))
    return whole.select(F.to_json(F.struct("total", F.lit(as_of.isoformat()).alias("calculatedAt"), "rows", "coverage"), {"ignoreNullFields": "false"}).alias("statistics"))


def facet_rollup(base: DataFrame, scope: str, catalogue=DEFAULT_CATALOGUE) -> DataFrame:
    """Facet counts with subtotals by kind, and the total."""
    return facts(base, scope, catalogue).rollup("kind", "key").agg(F.count("*").alias("count"), F.grouping_id().alias("level"))
