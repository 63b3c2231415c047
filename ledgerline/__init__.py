"""ledgerline — retail-banking ETL and risk analytics as Spark DataFrame jobs.

Layout
------
functions/  column expressions (date parsing, casts, rounding, scores)
sources/    raw inputs and outputs (CSV ingestion, landing zone, test bridge, sinks)
operators/  DataFrame -> DataFrame steps (cleaners, enrich, risk, aggregates, quality)
plans/      the warehouse, the fixed SQL questions, BI measures, the end-to-end run
streaming/  intentionally empty (the pipeline is batch only)
"""

from ledgerline.schemas import (  # noqa: F401
    ACCOUNT_TYPES,
    TXN_TYPES,
    QUALITY_GATE_THRESHOLD,
)
