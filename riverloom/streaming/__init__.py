"""riverloom.streaming."""
