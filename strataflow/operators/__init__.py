"""Joins, aggregations, windows and set operations on catalogue, interval, cell and log tables."""
