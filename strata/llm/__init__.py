"""Operators of a training-data pipeline over a table of documents.

One module per operator; ``queries`` registers them. Nothing else in the library
imports this subpackage.
"""
