"""Configurations as data: source and threshold files become small tables."""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from listweave.operators.cdc import discovery_scope


def load_yaml(path: str | Path) -> dict:
    value = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise ValueError(f"{path}: a mapping is expected")
    return value


def source_configs(folder: str | Path) -> list[dict]:
    """Configurations that name a source; names must be there, not blank, and unique."""
    found = []
    for path in sorted(Path(folder).glob("*.yaml")):
        value = yaml.safe_load(path.read_text(encoding="utf-8"))
        if isinstance(value, dict) and "source" in value:
            if not isinstance(value["source"], str) or not value["source"].strip():
                raise ValueError(f"{path}: source must be a name")
            found.append(value)
    names = [c["source"] for c in found]
    if not names or len(set(names)) < len(names):
        raise ValueError("sources must be there and unique")
    return found


def sources_table(spark: SparkSession, configs: list[dict]) -> DataFrame:
    """(source, adapter, transport, scope_hash, targets) of configurations."""
    rows = []
    for c in configs:
        scope, names = discovery_scope(c)
        rows.append((c["source"], c.get("source_adapter"), c.get("transport", "requests"), scope, names))
    return spark.createDataFrame(rows, "source string, adapter string, transport string, scope_hash string, targets array<string>")


def targets_table(spark: SparkSession, configs: list[dict]) -> DataFrame:
    """Enabled targets with their page range; a fixed number of pages gives the last page."""
    rows = []
    for c in configs:
        paging = c["discovery"].get("pagination", {})
        for t in c["discovery"]["targets"]:
            if t.get("enabled", True):
                start, total = t.get("start_page", paging.get("start_page", 1)), t.get("total_pages", paging.get("total_pages"))
                rows.append((c["source"], t["name"], int(start), None if total is None else int(start) + int(total) - 1, paging.get("strategy", "until_empty")))
    return spark.createDataFrame(rows, "source string, target_name string, start_page int, last_page int, strategy string")
