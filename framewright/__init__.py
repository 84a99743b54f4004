"""Spark-native analytics for subject-annotated clip datasets."""
