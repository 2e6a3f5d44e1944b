"""All queries of the document engine by name, with the SQL each can be held against."""

from __future__ import annotations

from .plans import check_queries, log_queries, record_queries, structure_queries, topic_queries

_PARTS = (structure_queries, topic_queries, log_queries, check_queries, record_queries)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
