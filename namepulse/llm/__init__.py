"""Operators for training-data corpora; nothing else in the package imports this one.

Every operator takes and returns DataFrames and keeps its own column names, so
that extra columns of an input never clash: only the columns it names are read.
"""
