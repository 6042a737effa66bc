"""Operators for large text corpora; nothing else in the package imports them."""
