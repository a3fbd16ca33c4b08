"""Queries over the given test tables, with the SQL that checks each of them."""
