"""Nested batch readers and the partitioned tables."""
