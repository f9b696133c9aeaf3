"""Operators for preparing training text, each built from Spark jobs.

Nothing else in the library imports this package; ``queries.py`` holds its registered queries.
"""
