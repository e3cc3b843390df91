"""Continuous arrival of batch files."""
