"""Spark-native engine for gridded time series."""
