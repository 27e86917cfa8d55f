"""Continuous intake and linking."""
