"""Spark-native analytics for cycling networks: tracks, paths, places, routes and their content."""

__version__ = "0.1.0"
