"""Operators for preparing training text: dedup, classifiers, mixing, chat, tokens.

Nothing else in the library imports this package.
"""
