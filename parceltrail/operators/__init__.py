"""Relational operators composed from the DataFrame API."""
