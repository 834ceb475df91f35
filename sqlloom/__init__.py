"""Spark-native curation of (question, schema, SQL) tables for text-to-SQL supervision."""

__version__ = "0.1.0"
