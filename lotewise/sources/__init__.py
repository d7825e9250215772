"""Where reports come from and where the two tables are kept."""
