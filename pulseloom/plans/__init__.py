"""Query catalogue: bindings to the supplied tables, queries and their SQL equivalents."""
