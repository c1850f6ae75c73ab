"""Operators on text corpora. Nothing else in the package imports this folder."""
