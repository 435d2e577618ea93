"""Composed refreshes, and the queries over the test tables."""
