"""Continuous ingest into a pool, and reports over windows of it."""
