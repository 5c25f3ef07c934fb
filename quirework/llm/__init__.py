"""Operators for building a training corpus, and their queries."""
