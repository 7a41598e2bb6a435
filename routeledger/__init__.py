"""Spark-native analytics for public-transport supply open data."""
