"""Operators for preparing language-model training corpora.

One module per operator; ``queries`` registers them.  Nothing else in the
library imports this package.
"""
