"""Where messages and tables are read from."""
