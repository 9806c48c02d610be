"""Operators that prepare text corpora. Their queries are in ``catalog``."""
