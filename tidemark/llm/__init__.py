"""Operators of a training-data pipeline over documents, pages, vectors and chats.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` registers one query per
operator over the given tables.
"""
