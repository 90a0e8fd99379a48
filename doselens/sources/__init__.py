"""Landed files and tables to DataFrames, and DataFrames to tables."""
