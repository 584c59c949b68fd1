"""Every operator as a query on the test tables, with the same query in SQL beside it."""

from tablewright.queries import (  # noqa: F401
    build_queries,
    change_queries,
    column_queries,
    grouped_queries,
    join_queries,
    maintain_queries,
    profile_queries,
    reconcile_queries,
    reshape_queries,
    source_queries,
    taxonomy_queries,
    validate_queries,
)
from tablewright.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
