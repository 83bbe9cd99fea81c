"""Flows over a lake: thin jobs around the operators."""
