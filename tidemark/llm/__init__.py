"""Operators for building training corpora, each in a module of its own.

Nothing else in the library imports this package. ``QUERIES`` and ``ORACLES`` of
``tidemark.llm.queries`` hold the registered queries.
"""
