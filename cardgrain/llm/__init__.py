"""Operators for large-scale training-data pipelines over text, vectors and urls.

Nothing else in the library imports this package.
"""
