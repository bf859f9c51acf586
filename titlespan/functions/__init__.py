"""Expressions as Spark SQL text.

Each function takes SQL expressions (a column name is one) and returns one, so an
expression of any depth is composed in Python and parsed once by `F.expr`. They work in
batch and on streams.
"""
