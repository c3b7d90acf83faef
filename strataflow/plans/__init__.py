"""Queries over the shipped tables, each with its SQL."""
