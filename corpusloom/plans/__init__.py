"""Named queries over the harness tables."""

from __future__ import annotations

from . import answer_queries, cube_queries, dashboard_queries, extraction_queries, filing_queries, mention_queries, merge_queries, passage_queries, profile_queries, rule_queries, selection_queries, source_queries, span_queries, temporal_queries, text_queries
from .registry import QUERIES, SQL, Query

__all__ = ["QUERIES", "SQL", "all_queries", "answer_queries", "cube_queries", "dashboard_queries", "extraction_queries", "filing_queries", "mention_queries", "merge_queries", "passage_queries", "profile_queries", "rule_queries", "selection_queries", "source_queries", "span_queries", "temporal_queries", "text_queries"]


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)
