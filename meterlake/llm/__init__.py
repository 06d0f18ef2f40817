"""Operators for preparing training text: deduplication, quality, language, tokens, packing."""
