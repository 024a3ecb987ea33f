"""Derived tables, and the queries over them with their SQL: QUERIES and ORACLE_SQL hold all of them."""

from readloom.plans import alignment_queries, annotation_queries, sample_queries, sequence_queries  # noqa: F401
from readloom.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
