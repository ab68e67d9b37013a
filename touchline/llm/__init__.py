"""Operators of a training-data pipeline over the tables documents, benchmark and labels.

Nothing else in the library imports this subpackage. Queries are in ``queries.py``.
"""
