"""Registered queries (Spark) and their DuckDB oracle twins.

Importing this package fills ``registry.QUERIES`` / ``registry.ORACLE``.
"""

from rewardloom.plans import registry
from rewardloom.plans import extraction_queries, cleaning_queries, prompt_queries, preference_queries, run_queries  # noqa: F401

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
