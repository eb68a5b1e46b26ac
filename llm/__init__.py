"""Operators for training-data pipelines, and the queries that run them.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
