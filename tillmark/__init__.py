"""Retail customer analytics on Spark: quality, identity, snapshots, segments, models, marts."""
