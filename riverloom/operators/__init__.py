"""riverloom.operators."""
