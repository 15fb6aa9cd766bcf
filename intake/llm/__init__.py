"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; it may use general
helpers of the library.  One module per operator, ``graph`` for connected
components, ``common`` for small shared helpers, ``queries`` for the
registered queries and their SQL.
"""
