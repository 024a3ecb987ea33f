"""Training-data operators: quality, language, sharding, packing and the like.

Nothing outside this subpackage imports it, so it can be removed whole.
"""
