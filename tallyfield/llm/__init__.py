"""Operators for preparing training data, with the queries that run them over whole tables."""
