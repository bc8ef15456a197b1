"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Every operator takes
and returns DataFrames and reads its columns by name, so extra columns do
not matter.  ``queries.py`` registers one query per operator.
"""
