"""Training-data operators: extraction, quality, deduplication, tokens, packing.

Nothing else in the library imports this subpackage; ``catalog`` lists its
queries for the driver contract.
"""
