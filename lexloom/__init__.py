"""lexloom: a PySpark-native engine for building and checking name corpora."""

__version__ = "0.1.0"
