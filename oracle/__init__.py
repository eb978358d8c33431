"""DuckDB statements of the registered queries, used only for checking."""
