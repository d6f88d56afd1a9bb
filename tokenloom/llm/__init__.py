"""Operators of a training-data pipeline, and the queries that apply them to whole tables.

Nothing else in the library imports this package.  Every operator is a function from
DataFrames to DataFrames; ``queries`` registers one ``opN_<name>`` query for each.
"""
