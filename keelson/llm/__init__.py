"""Corpus operators for training-data pipelines on Spark.

Nothing else in the library imports this subpackage.  Queries over the whole
tables are in :mod:`keelson.llm.queries`.
"""
