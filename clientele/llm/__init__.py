"""Training-data operators: URL filters, PII, language ID, near-duplicates,
packing, vector search, secret scans, exact dedup, mixing and LM scoring.

Nothing outside this subpackage imports it.
"""
