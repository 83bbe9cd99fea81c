"""Readers: raw files, lake tables, topics, and the catalog."""
