"""Operators that prepare training data: mixing, tokenising, archives, dedup, quality, scans."""
