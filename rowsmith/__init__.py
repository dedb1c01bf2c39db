"""Rowsmith: a PySpark-native engine for curating and searching directory data."""

__version__ = "0.1.0"
