"""Operators for preparing training text: deduplication, decontamination, extraction, archives, tokens, search.

Nothing else in the library imports this subpackage; it may be deleted whole.
"""
