"""Spark-native text and time-series analytics."""
