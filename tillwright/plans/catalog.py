"""All registered queries and their SQL checks."""

from __future__ import annotations

from tillwright.plans import (  # noqa: F401
    cleaning_queries,
    contract_queries,
    enrich_queries,
    feed_queries,
    profile_queries,
    quality_queries,
    recommend_queries,
    returns_queries,
    sales_queries,
    source_queries,
)
from tillwright.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
