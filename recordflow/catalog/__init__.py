"""The registered queries and their SQL twins, over the driver's tables."""

from recordflow.catalog.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
