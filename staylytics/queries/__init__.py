"""Query definitions for the registry (Spark side) and the oracle (DuckDB side)."""
