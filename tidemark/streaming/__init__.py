"""Incremental bronze and silver."""
