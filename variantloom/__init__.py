"""Spark-first operators for genome-wide association evidence.

Every operator takes and returns DataFrames and leaves the physical plan to
Catalyst and adaptive execution.  See README.md for the module map.
"""
