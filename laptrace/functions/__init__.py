"""Column expressions: Column in, Column out, all native (no Python UDF)."""
