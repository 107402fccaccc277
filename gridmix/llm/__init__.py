"""Operators of a large-scale training-data pipeline (documents, pages, embeddings).

Nothing else in the library imports this subpackage; it may be deleted as a
whole. ``queries`` registers one query per operator.
"""
