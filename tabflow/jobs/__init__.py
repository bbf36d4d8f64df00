"""Composite jobs: medallion layers, ingestion, incremental upsert."""
