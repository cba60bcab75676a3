"""Operators for preparing training text: ids, filters, deduplication, archives, token files."""
