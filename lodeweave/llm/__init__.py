"""Operators for building training data from text and weak evidence; nothing else in the library imports this."""
