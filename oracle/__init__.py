"""DuckDB oracle for the registered queries."""
