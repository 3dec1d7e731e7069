"""Property-graph patterns, typed decoding and graph algorithms as Spark DataFrame jobs."""
