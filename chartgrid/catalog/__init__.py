"""Registry of named queries (Spark) and their DuckDB oracle SQL."""
