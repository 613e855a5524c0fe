"""Spark-native analytics for documentation content and reader feedback."""
