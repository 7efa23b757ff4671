"""Change-feed analytics on Spark DataFrames.

Row-change logs go in (batch or stream); named, keyed, ordered JSON change events, an event store, exports,
log inventories and replay positions come out. Every operator is a DataFrame-in, DataFrame-out function.
"""
