"""Operators for preparing training data: scanning, extraction, quality, dedup, mixing, search."""
