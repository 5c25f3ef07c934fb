"""Whole dataflows: pages, star schema, chat examples, statistics, catalogue."""
