"""Spark-native analytics over sparse gene x cell counts and the records around them."""

__version__ = "0.1.0"
