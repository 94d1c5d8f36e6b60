"""Operators of a training-data pipeline; nothing else in the library imports them.

``registry`` lists the queries and their SQL. Each operator module states what it does with nulls,
empty and very long texts, ties, repeated rows, empty tables and extra columns.
"""
