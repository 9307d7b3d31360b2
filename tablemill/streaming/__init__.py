"""Streams from lines to landed tables."""
