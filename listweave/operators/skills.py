"""Skill normalisation against a catalogue of keys, labels and spellings.

The catalogue is a parameter: a JSON file or table of rows (key, label, aliases).  A small default
serves the demonstration queries.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listweave.functions.text import skill_token

#: A small catalogue; pass your own for real data.
DEFAULT_CATALOGUE = (
    {"key": "python", "label": "Python", "aliases": ["Python3"]},
    {"key": "postgresql", "label": "PostgreSQL", "aliases": ["Postgres"]},
    {"key": "sql", "label": "SQL", "aliases": []},
    {"key": "javascript", "label": "JavaScript", "aliases": ["JS"]},
    {"key": "react", "label": "React", "aliases": ["ReactJS", "React.js"]},
    {"key": "react-native", "label": "React Native", "aliases": []},
    {"key": "c", "label": "C", "aliases": []},
    {"key": "cplusplus", "label": "C++", "aliases": ["cpp"]},
    {"key": "csharp", "label": "C#", "aliases": []},
    {"key": "java", "label": "Java", "aliases": []},
    {"key": "spark", "label": "Apache Spark", "aliases": ["Spark"]},
)


def load_catalogue(path: str | Path) -> list[dict]:
    rows = json.loads(Path(path).read_text(encoding="utf-8"))
    return [{"key": r["key"], "label": r["label"], "aliases": list(r.get("aliases", []))} for r in rows]


def spellings(catalogue) -> dict[str, str]:
    """Token of each label and alias to its key; a spelling may name one key only."""
    out: dict[str, str] = {}
    for row in catalogue:
        for name in (row["label"], *row["aliases"]):
            token = " ".join(name.lower().split())
            if out.setdefault(token, row["key"]) != row["key"]:
                raise ValueError(f"spelling {name!r} names two skills")
    return out


def catalogue_table(spark: SparkSession, catalogue=DEFAULT_CATALOGUE) -> DataFrame:
    return spark.createDataFrame([(r["key"], r["label"], list(r["aliases"])) for r in catalogue], "key string, label string, aliases array<string>")


def _keys(values: Column, catalogue) -> Column:
    index = F.create_map(*[F.lit(x) for pair in sorted(spellings(catalogue).items()) for x in pair])
    tokens = F.transform(F.coalesce(values, F.array().cast("array<string>")), skill_token)
    return F.transform(tokens, lambda t: F.element_at(index, t))


def normalize_skills(values: Column, catalogue=DEFAULT_CATALOGUE) -> Column:
    """Sorted distinct keys of known spellings."""
    return F.array_sort(F.array_distinct(F.array_compact(_keys(values, catalogue))))


def preferred_skills(required: Column, preferred: Column, catalogue=DEFAULT_CATALOGUE) -> Column:
    """Keys of the preferred skills that are not required."""
    return F.array_except(normalize_skills(preferred, catalogue), normalize_skills(required, catalogue))


def unknown_skills(values: Column, catalogue=DEFAULT_CATALOGUE) -> Column:
    """Spellings that the catalogue lacks, sorted, each once."""
    given = F.coalesce(values, F.array().cast("array<string>"))
    odd = F.zip_with(given, _keys(given, catalogue), lambda v, k: F.when(k.isNull(), v))
    return F.array_sort(F.array_distinct(F.array_compact(odd)))


def with_skill_keys(jobs: DataFrame, catalogue=DEFAULT_CATALOGUE) -> DataFrame:
    """``jobs`` with required_skill_keys and preferred_skill_keys; empty unless enrichment succeeded."""
    done = F.col("enrichment_status") == "succeeded"
    none = F.array().cast("array<string>")
    required, preferred = F.col("skills_required"), F.col("skills_preferred")
    return jobs.withColumns({
        "required_skill_keys": F.when(done, normalize_skills(required, catalogue)).otherwise(none),
        "preferred_skill_keys": F.when(done, preferred_skills(required, preferred, catalogue)).otherwise(none),
    })


def skill_audit(jobs: DataFrame, catalogue=DEFAULT_CATALOGUE, top: int = 20) -> dict[str, DataFrame]:
    """Coverage of the catalogue by source, and the most frequent spellings that it lacks."""
    done = jobs.where("enrichment_status = 'succeeded'")
    both = F.concat(F.coalesce("skills_required", F.array().cast("array<string>")), F.coalesce("skills_preferred", F.array().cast("array<string>")))
    named = done.withColumns({"_n": F.size(both), "_unknown": unknown_skills(both, catalogue), "_keys": normalize_skills(both, catalogue)})
    return {
        "by_source": named.groupBy("source_code").agg(
            F.count("*").alias("enriched"), F.sum("_n").alias("mentions"), F.count_if(F.size("_keys") > 0).alias("normalized"), F.sum(F.size("_unknown")).alias("unknown_mentions")
        ),
        "unknown": named.select(F.explode("_unknown").alias("spelling")).groupBy("spelling").agg(F.count("*").alias("jobs")).orderBy(F.desc("jobs"), "spelling").limit(top),
    }
