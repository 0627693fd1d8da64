"""Spark-native document-graph analytics engine."""
