"""Operators that prepare text for training language models.

Nothing else in the package imports this folder. Each module holds one operator with its own general
interface; ``queries`` applies them to the given tables.
"""
