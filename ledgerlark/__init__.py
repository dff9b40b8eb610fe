"""Spark-native analytics over company fundamentals and pipeline-quality data."""
