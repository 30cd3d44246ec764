"""Operators that prepare text corpora for language-model training.

Nothing outside this subpackage imports it; its registered queries are in ``strandline.llm.queries``.
"""
