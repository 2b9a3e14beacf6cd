"""Reading logs, files and tables."""
