"""Operators of a training-data pipeline: one module per operator.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py``
imports it.
"""
