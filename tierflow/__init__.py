"""Spark-native analytics over multi-level collection pipelines."""
