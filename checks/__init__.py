"""Registered queries over the supplied tables and the SQL that must agree with them."""
