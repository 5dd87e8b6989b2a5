"""DataFrame operators: batching, the three traffic queries, merging, run bookkeeping."""
