"""Where reports come from and where tables are kept."""
