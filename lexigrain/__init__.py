"""Spark-native analysis and classification of labelled short texts."""
