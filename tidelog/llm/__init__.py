"""Operators of a training-data pipeline.

Nothing else in the library imports this package. Every operator takes the
names of the columns it reads and ignores all others, so further columns may
have any name.
"""
