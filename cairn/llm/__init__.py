"""Operators for preparing training data at scale: scoring, near and exact
duplicates, language, personal data, search, packing, sharding and mixing.

Nothing else in the library imports this subpackage. Every operator takes a
DataFrame and column names, reads only the columns it needs (so further columns,
whatever their names, never clash with its own) and returns a new DataFrame.
"""
