"""riverloom.sources."""
