"""Training-data operators: quality, language, dedup, personal data, packing, scoring and chat formatting.

Nothing else in the library imports this package.
"""
