"""Operators for training data: cleaning, deduplication, search, formatting and packing of documents.

Nothing else in the package imports this subpackage. Every operator takes the names of the columns
it reads, reads only those, and so ignores further columns whatever their names.
"""
