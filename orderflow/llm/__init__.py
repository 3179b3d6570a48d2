"""Operators for preparing training data: search, near duplicates, quality
rules and classifiers, packing, tokenization, sharding, web archives.

Nothing else in the library imports this subpackage.
"""
