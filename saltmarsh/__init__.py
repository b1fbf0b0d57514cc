"""Spark-native operators for end-of-day market data and the documents written about it."""
