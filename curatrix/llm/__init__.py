"""Corpus operators for language-model training data.

``queries()`` and ``oracle_sql()`` list the ``opN_*`` queries; nothing outside this
subpackage imports it.
"""

from curatrix.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
