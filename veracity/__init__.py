"""Veracity: a PySpark-native text-veracity analytics engine."""
