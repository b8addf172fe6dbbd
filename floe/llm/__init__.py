"""Operators for training-data pipelines (texts, tokens, vectors, dialogues).

Nothing outside this package imports it.  ``floe.llm.queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five
of them.
"""
