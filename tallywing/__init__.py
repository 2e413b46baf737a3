"""Feedback analytics written as plain Spark DataFrame transformations."""
