"""Operators for building training data from large text corpora.

Nothing outside this package (and its tests and ``corpus_pipeline.py``) imports it.
"""
