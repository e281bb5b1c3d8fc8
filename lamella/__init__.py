"""Spark-native engine for stacks of overlapping images and the tables around them."""
