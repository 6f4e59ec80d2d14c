"""Operators for building language-model training data.

Nothing outside this subpackage imports it. Each module holds one operator
built by one named method; ``queries`` registers them on the given tables.
"""
