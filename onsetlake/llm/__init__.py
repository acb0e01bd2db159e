"""Operators for large training corpora: token files, packing, near-duplicate
search, quality, toxicity, line and substring dedup, decontamination, secret
scans and web archives.

Nothing else in the library imports this subpackage.
"""
