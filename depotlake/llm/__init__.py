"""Operators for text corpora: cleaning, deduplication, mixing and tokens of training documents."""
