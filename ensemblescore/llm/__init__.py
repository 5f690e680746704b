"""Operators for preparing training data, each a Spark job over whole tables.

Nothing else in the library imports this subpackage. Every operator reads the columns
it names and ignores the others, so extra columns of any name do no harm; it returns
its own columns, one row per input row unless it says otherwise, repeated rows included.
"""
