"""Relational operators that Spark does not offer directly, as compositions of DataFrame operations."""
