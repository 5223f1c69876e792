"""Operators of a training-data pipeline: one module per numbered operator.

Each ``opNN_*`` module holds the general operator (DataFrames in, DataFrames
out); ``queries`` binds them to the given tables. Nothing else in the library
imports this subpackage.
"""
