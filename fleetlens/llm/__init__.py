"""Training-data operators: cleaning, deduplication, formatting, packing, encoding.

Nothing else in the library imports this package; it can be left out.
"""
