"""Query plans: the two reports, the registered queries and their DuckDB oracle SQL."""
