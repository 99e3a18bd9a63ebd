"""Operators for large-scale preparation of training text. Nothing else in the library imports this folder."""
