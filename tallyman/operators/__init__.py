"""Operators of a comparison."""
