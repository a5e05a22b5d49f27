"""Training-data operators: tokenising, language and quality scoring, duplicate
and leak search, pseudonyms, archives and licence scans.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds :func:`basketry.llm.queries.llm_queries` only where it can be imported.
"""
