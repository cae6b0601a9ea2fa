"""Training-data operators: search, language ID, packing, quality, deduplication, BPE,
WARC, secrets, sharding and near-duplicate joins.

The subpackage uses the session helpers of the library; nothing outside imports it.
"""
