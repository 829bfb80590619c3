"""Listing-shaped inputs derived from the given tables, and the queries and SQL that run on them."""
