"""Gristmill: a PySpark-native engine for extraction, data quality and training-data preparation."""
