"""Operators of a training-data pipeline (dedup, classifiers, extraction, search, mixing, tokenising).

Nothing else in the library imports this package; ``queries`` registers its entries.
"""
