"""Readers and writers: tables, point files, vectors, JSON evidence and file inventories."""
