"""Operators for training-data pipelines, their queries and SQL twins. Nothing else in the library imports this package.

Tasks carry their Python code along (pickled by value), so executors need no installed copy of the package.
"""
