"""Operators that prepare training data: deduplication, search, packing, scans, tokens, languages."""
