"""Training-data operators: de-duplication, extraction, scanning, packing, mixing, filters and search.

Nothing outside this package imports it.
"""
