"""Change-data files to checked changes, current-state tables and reports, on plain Spark."""
