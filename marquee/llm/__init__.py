"""Operators for preparing training text and vectors at scale.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
