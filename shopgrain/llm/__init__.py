"""Operators for preparing training data; nothing else in the package depends on them."""
