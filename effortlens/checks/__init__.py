"""Queries over the shared test tables, each with an independent SQL statement."""
