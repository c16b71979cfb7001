"""Spark-native record linkage and text-corpus operators."""
