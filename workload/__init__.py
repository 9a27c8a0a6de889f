"""Queries over the given tables: telemetry derived from them, run through the library."""
