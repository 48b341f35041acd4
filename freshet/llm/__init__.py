"""Training-data operators: quality, filtering, deduplication, decontamination, privacy, packing and scoring.

Nothing outside this subpackage imports it.
"""
