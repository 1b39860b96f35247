"""Operators for training data, and their queries on the given tables.

The queries are in ``queries`` (``QUERIES``, ``SQL``). Nothing else in the library imports this subpackage.
"""
