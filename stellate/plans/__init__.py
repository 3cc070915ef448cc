"""Query plans over the provided tables: the star build and the registry of
queries compared against the DuckDB oracle."""
