"""Continuous forms of the views."""
