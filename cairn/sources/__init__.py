"""Reading files into tables, and publishing tables."""
