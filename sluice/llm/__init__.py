"""Operators of a training-data pipeline over documents, conversations and embeddings.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``oracles.ORACLES`` hold its registered queries and their SQL.
"""
