"""Training-data operators: one module per operator, queries and oracle SQL in ``queries``.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
