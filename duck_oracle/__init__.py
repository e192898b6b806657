"""Independent SQL oracle (DuckDB dialect) for every registered query."""

from duck_oracle.sql import ORACLE, oracle_query  # noqa: F401
