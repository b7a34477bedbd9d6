"""Operators for preparing language-model training data.

Nothing else in the package imports this subpackage. ``queries.py`` registers
one query per operator and the corpus pipeline.
"""
