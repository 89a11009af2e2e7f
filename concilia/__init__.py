"""Spark-native reconciliation engine: pure DataFrame-to-DataFrame operators."""
