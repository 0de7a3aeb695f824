"""Operators of a training-data pipeline, each by its own method, as Spark jobs.

Nothing outside this folder imports it but ``__spark_entry__.py``, which adds its
queries when the folder is there.
"""
