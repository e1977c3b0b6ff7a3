"""Operators for preparing language-model training data at corpus scale.

Nothing else in the library imports this subpackage; it may be deleted as a
whole together with ``corpus_pipeline.py`` and ``tests/llm``.
"""
