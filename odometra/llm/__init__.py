"""Training-data operators (PII, near-dedup, token counts, decontamination, ...).

Self-contained: nothing outside this subpackage imports it, and deleting it
leaves the rest of the library working.
"""
