"""Incremental runs over landed items."""
