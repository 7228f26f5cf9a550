"""Operators of a training-data pipeline, with their registered queries.

Nothing else in the library imports this subpackage.
"""
