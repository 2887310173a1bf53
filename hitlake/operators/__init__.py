"""Joins that enrich hits."""
