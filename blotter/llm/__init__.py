"""Operators of a training-data pipeline; one module per operator.

Every operator reads only the columns it is told to read (other columns,
whatever their names, are ignored), so extra columns never clash with the
columns it works with.
"""
