"""Operators that prepare the text a language model is trained on.

Each module holds one operator with an interface of its own; ``queries`` applies
them to whole tables.
"""
