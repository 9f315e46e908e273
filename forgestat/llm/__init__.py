"""Training-data operators: the thirteen dealt operators and their queries.

Nothing else in the library imports this package. Operators take DataFrames
and column names, select only the columns they need (so further columns of any
name cannot clash), and say in their docstring what nulls, empty texts, ties
and repeated rows give.
"""
