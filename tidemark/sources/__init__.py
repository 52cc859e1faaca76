"""Readers and the mapping from the star-schema tables to the raw tables."""
