"""Readers and writers of the feeds."""
