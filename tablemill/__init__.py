"""Spark jobs that take relational tables and delimited text to clean, typed tables and grouped answers."""
