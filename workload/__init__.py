"""Queries over the supplied tables, one per operator, each with its SQL twin."""
