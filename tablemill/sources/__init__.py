"""Scans: stored tables, databases, delimited text, line streams."""
