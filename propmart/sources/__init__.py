"""Readers and writers: the only modules that touch paths.

In-memory rows (S13) need no reader of their own: ``spark.createDataFrame(rows,
schema)`` with a fixed schema, as the unit tests do for the literal rows.
"""
