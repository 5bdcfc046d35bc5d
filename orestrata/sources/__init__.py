"""Reading and writing: raw files, columnar tables, the catalog."""
