"""Operators for training-data pipelines: filters, deduplication, search, tokenising, packing, archives.

Nothing else in the library imports this package.
"""
