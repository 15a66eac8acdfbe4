"""Rules, their evaluation, scores, run records and batch state."""
