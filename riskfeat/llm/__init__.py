"""Training-data operators at corpus scale.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
