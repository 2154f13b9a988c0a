"""Operators for preparing training text at scale; nothing outside this
subpackage (and ``corpus_pipeline.py``) imports them."""
