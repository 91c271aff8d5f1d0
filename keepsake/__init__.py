"""Spark-native backup, retention, restore and SLI analytics over catalog metadata."""
