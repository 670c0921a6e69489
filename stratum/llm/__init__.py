"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns a DataFrame; `queries.py` applies them to the driver's
tables with production parameters.
"""
