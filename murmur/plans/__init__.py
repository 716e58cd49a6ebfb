"""Named queries; importing the modules fills the registry."""

from murmur.plans import (  # noqa: F401
    engagement_queries, join_queries, keyed_queries, report_queries, row_queries, source_queries,
    stream_queries, table_queries, trending_queries)
from murmur.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
