"""Spark-native preparation and quality analytics for text corpora."""
