"""riverloom.functions."""
