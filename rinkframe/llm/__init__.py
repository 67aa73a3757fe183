"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; `queries` registers one
query for each operator and the corpus pipeline.
"""
