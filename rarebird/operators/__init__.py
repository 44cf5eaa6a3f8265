"""Operators: feature preparation, clustering, anomaly flags, shares and monitoring rows,
enrichment / dedup, sampling and splits, partition layout."""
