"""Metrics of streams: the count and quality sums of batches, kept up to date."""
