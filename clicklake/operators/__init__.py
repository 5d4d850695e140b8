"""Metrics over event logs and result logs: DataFrame in, DataFrame out."""
