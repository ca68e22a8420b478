"""Change-log analytics on Spark DataFrames.

Inserts, updates and deletes become *signed rows*: a row plus an integer weight
``w``.  Joins multiply weights, aggregates sum them, and every view stays exact
under retraction whether it runs on a batch DataFrame or on a stream.
"""
