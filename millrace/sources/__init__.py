"""Readers, writers and the schemas of the raw tables."""
