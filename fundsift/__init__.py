"""Screening and ranking of investment funds as Spark DataFrame jobs."""

__version__ = "0.1.0"
