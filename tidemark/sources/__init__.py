"""Reading raw files and writing tables and reports."""
