"""Operators for preparing training text: archives, cleaning, scoring, tokens, duplicates, packing."""
