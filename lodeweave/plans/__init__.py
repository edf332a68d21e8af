"""Queries of the driver contract, each with its SQL where SQL can say it."""
