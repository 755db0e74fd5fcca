"""Incremental collection of record files."""
