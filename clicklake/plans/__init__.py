"""Reporting tables, the report catalogue over them, and page data sets."""
