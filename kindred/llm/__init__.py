"""Operators for large training corpora; nothing else in the library imports this package."""
