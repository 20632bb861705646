"""Shared physical patterns (exact medians, prefix scans) and whole runs."""
