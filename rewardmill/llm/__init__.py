"""Corpus operators for training-data pipelines.

Nothing outside this subpackage imports it; deleting it (with its tests and
``corpus_pipeline.py``) leaves the rest of the library intact.
"""
