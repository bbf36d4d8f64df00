"""DataFrame -> DataFrame operators (relational, quality, windows, skew, upsert)."""
