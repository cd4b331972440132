"""The engine's registered queries and the DuckDB SQL that states each result."""

from brindle.plans import mechanisms, streams  # register their queries
from brindle.plans.catalog import QUERIES, oracle_sql, queries

__all__ = ["QUERIES", "mechanisms", "oracle_sql", "queries", "streams"]
