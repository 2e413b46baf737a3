"""Checked queries: each runs a library operator on the driver tables and states the same in SQL."""
