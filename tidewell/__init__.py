"""Spark-native cleaning, matching, verification and operations analytics over tables of text and events."""
