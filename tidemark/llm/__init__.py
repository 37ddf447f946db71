"""Operators for preparing language-model training data.

Each operator is a function from DataFrames to a DataFrame.  ``queries`` in
this package holds the registered queries built from them.
"""
