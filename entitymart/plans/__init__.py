"""Whole data flows."""
