"""Query plans: fixtures built from the driver's tables, the registered
queries, and their DuckDB oracles."""
