"""Operators of a training-data pipeline, written as Spark jobs.

Each module holds one operator; ``queries`` registers them over the driver's
tables. Nothing outside this subpackage imports it (only ``__spark_entry__``
and ``corpus_pipeline`` do).
"""
