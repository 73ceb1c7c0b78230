"""Spark-native engine for structuring collections of mathematical Markdown."""
