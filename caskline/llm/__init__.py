"""Operators for training corpora: mixing, extraction, filtering, archives, deduplication."""
