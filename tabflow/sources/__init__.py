"""Readers and writers: driver tables, delimited text, JSON, Parquet layers."""
