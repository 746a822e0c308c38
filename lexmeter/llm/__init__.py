"""Operators that prepare text for training language models.

Each module holds one operator and the query that applies it to a whole table.
Nothing else in the library imports this package.
"""
