"""Training-data operators: mixing, search, sharding, deduplication, filters and tokenisation.

Nothing else in the package imports this subpackage; it can be removed as a whole.
"""
