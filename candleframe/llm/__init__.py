"""Operators for preparing training text, each a Spark job over whole tables.

Nothing outside this subpackage imports it. Every operator takes DataFrames and returns
DataFrames; the registered queries (``queries.py``) are thin projections of their results.
"""
