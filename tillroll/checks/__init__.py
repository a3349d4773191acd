"""The operators bound to the given tables, with their SQL oracles."""
