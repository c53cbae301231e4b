"""Operators for preparing language-model training data, their queries and their SQL.

Nothing else in the library imports this subpackage.
"""
