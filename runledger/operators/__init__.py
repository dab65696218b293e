"""DataFrame-to-DataFrame operators over log records."""
