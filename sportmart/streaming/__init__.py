"""Incremental load of newly landed files."""
