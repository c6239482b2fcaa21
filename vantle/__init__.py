"""Spark-native spatio-temporal feature engine."""
