"""Training-data pipeline operators: mixing, dedup, scans, language ID, packing, quality, PII, conversation repair, periodic runs, embeddings.

Nothing else in the library imports this subpackage.
"""
