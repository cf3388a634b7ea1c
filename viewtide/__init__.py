"""viewtide: engagement analytics for content platforms, as Spark jobs.

Operators take and return Spark DataFrames. ``sources`` and ``sinks`` read and
write, ``functions`` holds column expressions, ``operators`` the batch-and-stream
transformations, ``streaming`` the query lifecycle, and ``plans`` the end-to-end
jobs and the query catalogue.
"""
