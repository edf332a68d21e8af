"""Relational operators built on the DataFrame API."""
