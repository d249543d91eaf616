"""All registered queries."""

from rondel.plans import queries_graph, queries_models, queries_streams, queries_tables, queries_text  # noqa: F401
from rondel.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
