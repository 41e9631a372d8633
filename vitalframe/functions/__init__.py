"""Column-level helpers (R missing-value rules, scalar conversions, rule tables)."""
