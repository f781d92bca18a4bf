"""Operators for the preparation of training data.

Nothing else in the package imports this folder.
"""
