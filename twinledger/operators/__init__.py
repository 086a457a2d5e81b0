"""Comparison operators: schema, keys, rows, columns, fingerprints, tenants."""
