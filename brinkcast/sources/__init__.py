"""Readers and writers of landed files, and the append-only table store."""
