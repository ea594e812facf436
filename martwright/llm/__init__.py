"""Operators for large-scale training-data preparation.

Nothing outside this folder (except the guarded entry module and
``corpus_pipeline.py``) imports it.
"""
