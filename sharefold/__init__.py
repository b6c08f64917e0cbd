"""Equity-market feeds as Spark tables: parse, clean, cut, upsert and query landed responses."""

__version__ = "0.1.0"
