"""Spark-native curation and entity-resolution engine."""
