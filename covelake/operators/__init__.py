"""Relational, history, quality, reconciliation, metric and model operators over DataFrames."""
