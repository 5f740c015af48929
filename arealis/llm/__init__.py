"""Operators that prepare training text: language, copies, mixing, tokens, private data."""
