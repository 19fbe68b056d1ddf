"""Operators for preparing language-model training data, one module per operator.

Every operator is a ``DataFrame -> DataFrame`` function with its own general interface;
``queries.py`` registers the thin ``opN_<name>`` query of each.  Nothing outside this folder
(and ``corpus_pipeline.py``) imports it.
"""
