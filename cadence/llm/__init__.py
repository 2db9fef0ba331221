"""Operators for preparing training corpora at scale.

Thirteen operators over the ``documents``, ``benchmark`` and ``embeddings``
tables, each in a module of its own; ``queries.py`` registers one query per operator.  Nothing outside
this package imports it.
"""
