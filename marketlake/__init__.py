"""Spark operators for a market-data lake: ticks, rates, bars, returns, facts."""

__version__ = "0.1.0"
