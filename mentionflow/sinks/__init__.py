"""Where posts go: the table, daily JSON lines, a database."""
