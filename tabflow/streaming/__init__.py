"""Structured Streaming helpers: drop-file feeds, file sources, bounded runs."""
