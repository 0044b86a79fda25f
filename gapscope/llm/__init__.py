"""Operators of a training-data pipeline, each a DataFrame -> DataFrame function.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it; the
registered queries are listed in ``gapscope.llm.registry``.
"""
