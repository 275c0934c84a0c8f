"""Operators of a training-data pipeline, each in a module of its own; ``registry`` names their queries.

Nothing else in the library imports this package.
"""
