"""Operators for preparing training data: deduplication, quality, privacy, tokens, mixing."""
