"""Operators for large-scale training-data preparation.

One module per operator; ``queries`` registers them. Nothing else in the
library imports this subpackage.
"""
