"""Operators for building training data from text tables.

One module per operator; ``queries`` registers the ``opN_<name>`` queries.
Nothing outside this folder imports it.
"""
