"""Operators of a training-data pipeline over documents, embeddings and conversations.

Nothing else in the library imports this subpackage. ``queries`` registers one query for each operator.
"""
