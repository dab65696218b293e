"""Log lines to typed records, line numbers, loads."""
