"""Operators on cell tables, units, samples and parameter tables."""
