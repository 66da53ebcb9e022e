"""Operators for training-data corpora: filters, near duplicates, formatting, packing and token files."""
