"""The registered queries (catalog), their DuckDB oracle SQL and parameters."""
