"""Contribution analytics as DataFrame and SQL plans."""
