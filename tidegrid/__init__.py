"""Spark-native engine for gridded time series: cubes as long tables of time, lat, lon and variables."""

__version__ = "0.1.0"
