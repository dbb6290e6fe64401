"""DataFrame-to-DataFrame operators: keys, integrity, checks, profiling."""
