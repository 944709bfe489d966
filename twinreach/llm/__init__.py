"""Operators of a training-data pipeline over web documents.

Nothing else in the library imports this subpackage.
"""
