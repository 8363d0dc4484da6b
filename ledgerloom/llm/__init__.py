"""Training-data operators: tokenisation, deduplication, packing, filters, sharding.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` registers one query per
operator over the driver's tables.
"""
