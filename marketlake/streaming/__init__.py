"""Structured Streaming paths. They share the batch operators."""
