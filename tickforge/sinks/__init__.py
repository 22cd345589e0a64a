"""Writing tables, JSON exports and broker records."""
