"""Operators for large text corpora: cleaning, deduplication, splitting, packing, leakage, reading level."""
