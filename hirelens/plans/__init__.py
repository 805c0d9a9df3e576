"""Whole jobs: import, train, predict, report."""
