"""Operators for building language-model training data on Spark.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
