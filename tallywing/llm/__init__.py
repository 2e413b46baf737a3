"""Operators for large text corpora: filtering, deduplication, scanning, scoring and packing."""
