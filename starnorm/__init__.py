"""Flat records to a checked star schema, on Spark."""
