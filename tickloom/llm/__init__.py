"""Operators for preparing training text: scans, classifiers, deduplication, packing."""
