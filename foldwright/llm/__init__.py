"""Operators for preparing training corpora: deduplication, rules, scans, mixing, search, extraction, packing."""
