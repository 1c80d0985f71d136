"""Operators for preparing training data: cleaning, deduplication, classification, mixing.

Nothing outside this subpackage imports it.
"""
