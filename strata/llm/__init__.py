"""Operators for preparing language-model training data, as Spark jobs.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
