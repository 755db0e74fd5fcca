"""All registered queries; importing this module loads every query module."""

from __future__ import annotations

from laptrace.plans import (  # noqa: F401
    athlete_queries, label_queries, model_queries, page_queries, race_queries, source_queries, stream_queries,
)
from laptrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
