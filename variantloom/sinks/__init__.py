"""Exports and manifest upserts."""
