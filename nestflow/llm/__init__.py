"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  Every operator takes
and returns DataFrames; the registered queries are in ``queries``.
"""
