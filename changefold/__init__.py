"""changefold: change-data-capture analytics on stock Spark.

Change envelopes are parsed into an append-only bronze log, folded into one
current row per key (the silver state), and joined into the gold
``open_orders`` table that feeds four order KPIs.  Every step is a DataFrame
transformation, so the same code runs as a batch job or inside
Structured Streaming ``foreachBatch``.
"""

from changefold.specs import REGISTRY, TableSpec, spec_for

__all__ = ["REGISTRY", "TableSpec", "spec_for"]
