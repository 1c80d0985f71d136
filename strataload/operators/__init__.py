"""Relational operators: loads, lookups, identity, mastering, quality."""
