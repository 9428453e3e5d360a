"""Operators of a training-data pipeline over document tables.

Each module holds one operator with a general interface (any table, any
column names); ``queries.py`` registers the thin queries over the generated
tables. Nothing else in the library imports this subpackage.
"""
