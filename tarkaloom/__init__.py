"""Spark-native analytics for annotated text corpora and concept graphs."""
