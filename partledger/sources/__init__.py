"""Reading files, tables and control records."""
