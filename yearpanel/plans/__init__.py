"""Whole analyses, the registered queries and their SQL twins."""
