"""Spark-native engine for vacancy data: extraction, classification, entity resolution and publication."""

__all__ = ["session"]
