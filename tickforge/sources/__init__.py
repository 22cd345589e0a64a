"""Reading files, tables and streams with explicit schemas."""
