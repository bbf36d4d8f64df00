"""Column-level helpers (return ``Column``), all built from native functions."""
