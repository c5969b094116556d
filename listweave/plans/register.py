"""The registry: a name, a query of (spark, sf_dir), and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listweave.plans.adapters import AS_OF, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}


def at() -> Column:
    """The reports' time as a Column; made when asked for, since there may be no session at import."""
    return F.lit(AS_OF.isoformat(sep=" ")).cast("timestamp_ntz")


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``views`` are the state tables that its SQL names."""
    def keep(f: Query) -> Query:
        QUERIES[name] = (f, with_views(sql, *views) if sql and views else sql)
        return f
    return keep
