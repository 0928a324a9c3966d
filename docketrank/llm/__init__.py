"""Operators of a training-data pipeline: texts, pages, vectors and conversations at scale.

Each module holds one operator with its own interface; ``queries`` applies them to whole tables.
Nothing else in the library imports this package.
"""
