"""Operators for preparing training data: filters, duplicates, mixing, packing, search."""
