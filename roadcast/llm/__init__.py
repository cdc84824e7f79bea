"""Operators for large training-text collections; nothing else in the package imports them."""
