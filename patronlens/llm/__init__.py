"""Operators for preparing training text: scans, tokens, duplicates, search, shards, mixes and rules."""
