"""Spark-native feature, labelling and dataset engine for bar data."""
