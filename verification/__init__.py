"""Queries over the generated test tables and the SQL that checks them."""
