"""Test-table views, the query catalogue and its DuckDB twins."""
