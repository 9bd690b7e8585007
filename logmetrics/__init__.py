"""logmetrics: application-log metrics on Spark.

Parse JSON log records, aggregate them into per-service / per-level metrics in batch or
Structured Streaming, keep the results as idempotent time-series tables and answer the
dashboard questions (counter rates, histogram quantiles, selections, reducers, bands)
over those tables.  Every public function maps DataFrame -> DataFrame so that the same
code serves a batch backfill and a ``foreachBatch`` micro-batch.
"""

__version__ = "0.1.0"
