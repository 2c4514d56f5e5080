"""All named queries of the text operators."""

from __future__ import annotations

from tillwright.llm import (  # noqa: F401
    chat_queries,
    curriculum_queries,
    jaccard_queries,
    language_queries,
    line_queries,
    passage_queries,
    phrase_queries,
    ppm_queries,
    quality_queries,
    repair_queries,
    toxic_queries,
    url_queries,
    vector_queries,
)
from tillwright.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
