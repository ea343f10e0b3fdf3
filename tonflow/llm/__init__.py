"""Operators for preparing language-model training data.

Nothing else in the library imports this package.  Each module holds one operator; general
helpers are in :mod:`tonflow.llm.common`, the registered queries in :mod:`tonflow.llm.queries`.
"""
