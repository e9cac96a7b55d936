"""DataFrame-level operators: profiling, cleaning, enrichment, load, constraints."""
