"""Whole reports and cycles composed from operators."""
