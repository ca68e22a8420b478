"""Relational operators over signed rows."""
