"""Spark-native engine for turning noisy extracts of company accounts into checked tables."""
