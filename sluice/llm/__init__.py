"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing outside this package imports it, except the guarded registration of
its queries in ``__spark_entry__``.
"""
