"""Training-data pipeline operators.

Nothing else in the library imports this package; the queries over the
synthetic text tables are registered by ``ledgerline.llm.queries``.
"""
