"""Reading data sets, writing results, and keeping records in append-only tables."""
