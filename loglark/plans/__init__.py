"""Whole jobs: a run over batches, and the reports over finished runs."""
