"""Operators for building training corpora: deduplication, tokenization, packing, scoring, masking.

Nothing else in the library imports this subpackage. ``queries`` holds the registered queries.
"""
