"""Writing tables, files and payloads."""
