"""Training-data operators: scoring, deduplication, decontamination, tokenizing.

Nothing outside this subpackage imports it.
"""
