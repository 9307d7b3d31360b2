"""Table-to-table operators."""
