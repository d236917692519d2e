"""Spark-first catalogue-data and training-data engine."""
