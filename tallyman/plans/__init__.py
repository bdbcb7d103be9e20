"""Whole comparisons, and the registered queries."""
