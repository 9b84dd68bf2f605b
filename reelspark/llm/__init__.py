"""Operators of a training-data pipeline over text corpora: search, cleaning, labelling, tokenising, sharding.

Each module is one operator with its own general interface; ``queries`` registers one query for each. Nothing
else in the library imports this package.
"""
