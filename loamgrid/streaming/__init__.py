"""Incremental jobs over arriving cell files."""
