"""Incremental (micro-batch) variants of the chunked scans.

The reference has no streaming operator; it reads large inputs in chunks
(a chunked database cursor, ``read_csv(chunksize=…)``). Here a folder of
condition files is consumed as a Structured Streaming file source, a bounded
number of files per micro-batch, with the running aggregate kept in Spark's
state store.
"""
