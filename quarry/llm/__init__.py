"""Training-data operators: deduplication, mixing, sharding, archives,
chat formatting, decontamination, quality and language-model scoring.

Nothing else in the library imports this package. Its registered queries
and their SQL are in :mod:`quarry.llm.queries`.
"""
