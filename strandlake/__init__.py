"""Spark-native analytics for resequencing and comparative genomics."""
