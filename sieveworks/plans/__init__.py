"""Registered queries over the fixture tables, each with its DuckDB counterpart."""
