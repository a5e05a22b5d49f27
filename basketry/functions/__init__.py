"""Column-level helpers (no Python UDFs)."""
