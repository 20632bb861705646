"""Scans and parsers that turn files into canonical DataFrames."""
