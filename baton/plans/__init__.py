"""Registered queries (with their DuckDB oracles) and plan inspection."""

from baton.plans.catalog import oracle_sql, queries, table
from baton.plans.inspect import input_paths, plan_text, reads_only

__all__ = ["input_paths", "oracle_sql", "plan_text", "queries", "reads_only", "table"]
