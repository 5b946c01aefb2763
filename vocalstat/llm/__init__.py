"""Operators for preparing text at scale: dedup, packing, scans, mixing, archives, classifiers."""
