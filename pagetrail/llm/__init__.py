"""Operators for large training-data corpora.

One module per operator; ``queries.py`` registers them. Nothing else in the
library imports this subpackage.
"""
