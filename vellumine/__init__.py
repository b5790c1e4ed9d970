"""A PySpark-native engine for document-intelligence tables."""

__version__ = "0.1.0"
