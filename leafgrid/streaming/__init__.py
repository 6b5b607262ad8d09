"""Incremental forms for file streams."""
