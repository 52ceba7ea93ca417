"""Operators for building language-model training data.

One module per operator; nothing else in the library imports this subpackage.
``queries`` registers the operators over the given tables.
"""
