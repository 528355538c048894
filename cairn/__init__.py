"""Spark-native operators for a layered (bronze, silver, gold) retail warehouse."""
