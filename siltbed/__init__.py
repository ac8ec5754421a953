"""Spark-native reading, reconciling and loading of log-structured-merge tables."""
