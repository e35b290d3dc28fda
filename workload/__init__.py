"""Feeds derived from the driver's tables, and the queries that run on them."""
