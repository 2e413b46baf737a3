"""Nothing to build here: every task works on batch tables.

The row-level functions and keyed counts are ordinary DataFrame expressions, so they also accept a
streaming DataFrame (see ``tests/test_streaming.py``); no streaming operator is added for that.
"""
