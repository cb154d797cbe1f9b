"""Whole runs composed from operators, and the registry of queries."""
