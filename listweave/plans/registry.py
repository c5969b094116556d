"""All queries of the listing engine with their DuckDB equivalents."""

from __future__ import annotations

from listweave.plans import serving_queries, state_queries, text_queries  # noqa: F401  they register themselves
from listweave.plans import checking_queries  # noqa: F401  after the queries whose SQL it takes up
from listweave.plans.register import QUERIES, Query


def queries() -> dict[str, Query]:
    return {n: f for n, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {n: s for n, (_, s) in QUERIES.items() if s}
