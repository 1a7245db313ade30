"""Incremental arrival of raw records."""
