"""DuckDB text of every query key, the independent correctness check."""
