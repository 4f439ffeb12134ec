"""Structured Streaming forms of ingest, features, outcomes and the cycle."""
