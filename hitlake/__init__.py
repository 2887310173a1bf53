"""Clickstream feed to lake, on PySpark."""
