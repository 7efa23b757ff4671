"""Capture as a Structured Streaming query.

Each micro-batch runs the batch operators. What must outlive a batch (table maps, ids, loaded catalogs) is kept in
parquet folders named after the batch that wrote them. A batch that runs again rewrites its own folders and reads only
those of earlier batches, so a retry gives the same result.
"""
