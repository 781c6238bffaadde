"""Spark-native ticket-sales and marketing analytics."""
