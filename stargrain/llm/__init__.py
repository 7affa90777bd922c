"""Operators for preparing language-model training corpora.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; :mod:`stargrain.llm.queries`
applies them to the given tables with production parameters.
"""
