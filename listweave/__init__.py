"""Spark-native analytics for collected web listings."""
