"""Reports, each one Spark job over all providers instead of a loop of queries."""
