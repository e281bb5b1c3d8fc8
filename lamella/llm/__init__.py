"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; ``queries.py`` lists the queries
that apply the operators to the driver's tables.
"""
