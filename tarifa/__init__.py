"""Spark-first engine for multi-source product listings and price history."""
