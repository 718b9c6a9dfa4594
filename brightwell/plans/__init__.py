"""Registered queries: each is a Spark job over the given tables with its check in SQL."""
