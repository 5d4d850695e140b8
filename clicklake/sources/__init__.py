"""Inputs and outputs: log files, catalog tables, and logs derived from the supplied tables."""
