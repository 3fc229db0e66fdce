"""Operators that prepare text for training: dedup, scoring, filtering, mixing, tokens."""
