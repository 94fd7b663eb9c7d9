"""Spark-native selection, grouping, scoring and evaluation of dated text records."""
