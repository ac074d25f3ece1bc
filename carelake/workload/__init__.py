"""Queries that run every operator over the given tables, and their SQL counterparts."""
