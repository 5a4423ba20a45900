"""Operators for preparing language-model training corpora.

One module per operator; ``queries.py`` binds them to the driver tables.
Nothing else in the library imports this package.
"""
