"""Health reports as JSON and Markdown files, replaced whole or not at all."""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame


def as_rows(sections: dict[str, DataFrame]) -> dict[str, list[dict]]:
    """Sections as sorted rows; they are reports, a few rows a source."""
    out = {}
    for name, df in sections.items():
        rows = [r.asDict(recursive=True) for r in df.collect()]
        out[name] = sorted(rows, key=lambda r: json.dumps(r, default=str, sort_keys=True))
    return out


def cell(value: Any) -> str:
    """A Markdown table cell: pipes escaped, one line, a dash for nothing."""
    return "—" if value is None else str(value).replace("|", "\\|").replace("\n", " ").replace("\r", " ")


def markdown(report: dict) -> str:
    lines = ["# Data health", "", f"Captured: {report['captured_at']}", "", "Sources without jobs: " + (", ".join(report["sources_without_jobs"]) or "none")]
    if report.get("alerts"):
        lines += ["", "## Alerts", ""] + [f"- {cell(a['source'])}: {cell(a['metric'])} = {cell(a['observed'])}, threshold {cell(a['threshold'])}" for a in report["alerts"]]
    for name, rows in report["sections"].items():
        lines += ["", f"## {name}", ""]
        if not rows:
            lines.append("No records.")
            continue
        columns = list(rows[0])
        lines += ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
        lines += ["| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in rows]
    return "\n".join(lines) + "\n"


def build(sections: dict[str, DataFrame], alerts: DataFrame, captured_at: datetime, expected: list[str]) -> dict:
    rows = as_rows(sections)
    have = {r["source"] for r in rows["inventory"]}
    seen = {r["source"] for part in rows.values() for r in part if "source" in r}
    sources = sorted(set(expected) | seen)
    return {
        "schema_version": 1, "captured_at": captured_at.replace(tzinfo=captured_at.tzinfo or timezone.utc).isoformat(), "sources": sources,
        "sources_without_jobs": sorted(set(sources) - have), "sections": rows, "alerts": as_rows({"a": alerts})["a"],
    }


def save(report: dict, folder: str | Path) -> list[Path]:
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    stamp = datetime.fromisoformat(report["captured_at"]).strftime("%Y%m%dT%H%M%S%fZ")
    out = []
    for suffix, text in ((".json", json.dumps(report, ensure_ascii=False, indent=2, default=str)), (".md", markdown(report))):
        path = folder / f"{stamp}-{uuid.uuid4().hex[:8]}{suffix}"
        temporary = path.with_name(path.name + ".part")
        temporary.write_text(text, encoding="utf-8")
        os.replace(temporary, path)
        out.append(path)
    return out
