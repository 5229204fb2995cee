"""riverloom.plans."""
