"""Operators for large-scale training-data pipelines (documents, pages, tokens).

Nothing outside this folder imports it, apart from the guarded import in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
