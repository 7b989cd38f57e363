"""Operators of a training-data pipeline over tables of documents.

Nothing outside this package imports it. Every operator takes and returns
DataFrames; Python sees rows only as Arrow batches.
"""
