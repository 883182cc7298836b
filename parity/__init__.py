"""The operators on the given tables, each beside an independent SQL statement."""
