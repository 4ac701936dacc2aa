"""Operators of a training-data pipeline, one module per operator.

Nothing outside this package (but ``__spark_entry__`` and
``corpus_pipeline.py``) imports it.
"""
