"""Operators for preparing training corpora (one module per operator).

Nothing outside this subpackage (and ``corpus_pipeline.py``, which counts as
part of it) imports it. ``catalogue`` lists the queries ``opN_<name>``.
"""
