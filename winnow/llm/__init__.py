"""Training-data operators: dedup, counting, filtering, language ID, packing, WARC.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
