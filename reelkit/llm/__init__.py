"""Training-data operators: deduplication, sharding, scoring, tokenising, search, mixing, fingerprints.

Nothing else in the library imports this subpackage.
"""
