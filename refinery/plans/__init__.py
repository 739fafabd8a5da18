"""Whole jobs: the three refresh methods, run metrics and reports."""
