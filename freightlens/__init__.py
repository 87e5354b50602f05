"""Batch analytics of shipments on Spark: scopes, spines, wide marts, document links and data-quality rules."""
