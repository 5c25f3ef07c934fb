"""Spark operators that turn parsed documents into analysis-ready tables."""
