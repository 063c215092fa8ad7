"""Where change events and tables are read from and written to."""
