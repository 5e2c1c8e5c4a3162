"""Training-data operators: licence scan, BPE, sharding, similarity joins, URL filter,
exact dedup, personal data, packing and toxicity.

Nothing else in the library imports this subpackage.
"""
