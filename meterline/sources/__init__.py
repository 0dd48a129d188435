"""Reading raw files and dimensions, writing silver and gold tables."""
