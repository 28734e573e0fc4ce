"""Continuous ingest and the incremental trace lookup."""
