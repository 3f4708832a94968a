"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this package; ``queries.py`` registers one
query per operator.  Every operator takes DataFrames, names its id and text
columns by parameter, selects only those (extra columns, whatever they are
called, never clash) and states in its docstring what nulls, empty texts,
repeated rows and empty tables give.
"""
