"""Keys and content hashes."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(value: Any) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def sha256_text(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def object_key(source: Column | str, url: Column | str) -> Column:
    """Key of a raw object: SHA-256 over source and URL."""
    return F.sha2(F.concat_ws(":", source, url), 256)


def content_hash(x: Column | str) -> Column:
    return F.sha2(F.col(x) if isinstance(x, str) else x, 256)


def row_hash(*columns: Column | str) -> Column:
    """Hash of a row's values as JSON in which nulls stay."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
