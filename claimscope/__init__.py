"""Spark-native provider-spending analytics engine."""
