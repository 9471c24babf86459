"""Operators for large-scale training data.  Nothing else in termloom imports them."""
