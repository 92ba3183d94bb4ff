"""tallyquill: a PySpark-native engine for document-derived question banks."""

__version__ = "0.1.0"
