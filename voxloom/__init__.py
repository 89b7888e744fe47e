"""Spark-native preparation of speech training data."""

__version__ = "0.1.0"
