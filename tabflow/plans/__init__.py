"""Plan inspection (explain text, exchange counts) and reuse helpers (cache)."""
