"""Operators that prepare text corpora for language-model training.

Each operator module has a general function on DataFrames and the thin query
that applies it to the standard tables; ``registry`` lists the queries.
"""
