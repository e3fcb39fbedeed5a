"""DuckDB oracle SQL for the driver's correctness gate (not part of the library)."""
