"""Table-in, table-out DataFrame operators for evidence analytics."""
