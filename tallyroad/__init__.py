"""Spark-native analytics for counter series, zones, networks and travelled distance."""
