"""Per-batch log metrics: counts, mean latency, percentiles, error counts and rates.

Everything is one declarative aggregation: Spark plans a partial (map-side) aggregate
per task and a final aggregate after a hash exchange on the group keys, so a hot
service costs one partial buffer per task, never a skewed shuffle partition.
``percentile_approx`` keeps a mergeable sketch per group (ObjectHashAggregate), so
even the percentiles combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logmetrics.config import (
    DEFAULT_ACCURACY,
    ERROR_LEVEL,
    METRIC_ERROR_RATE,
    METRIC_LATENCY,
    METRIC_LOGS_PER_BATCH,
    PERCENTILES,
)

LATENCY = "response_time_ms"


def is_error(level_col: str = "level") -> Column:
    """Exact, case-sensitive test for the error level (null level is not an error)."""
    return F.col(level_col) == F.lit(ERROR_LEVEL)


def percentile_columns(col: str = LATENCY, accuracy: int = DEFAULT_ACCURACY, exact: bool = False,
                       prefix: str = "", kind: str = "int") -> list[Column]:
    """p50 / p95 / p99 of ``col``.

    Approximate: one ``percentile_approx`` call with an array of ranks (one sketch for
    the three values).  Exact: ``percentile_disc`` (a value-count map per group,
    partial-aggregated), in the column's own type (``kind``, INT for latencies)."""
    if exact:
        return [
            F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY `{col}`)").cast(kind).alias(prefix + name)
            for name, q in PERCENTILES
        ]
    arr = F.percentile_approx(F.col(col), [q for _, q in PERCENTILES], accuracy)
    return [arr.getItem(i).alias(prefix + name) for i, (name, _) in enumerate(PERCENTILES)]


def log_measures(accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> list[Column]:
    """The streaming job's measures for one group of logs."""
    return [
        F.count(F.lit(1)).alias("log_count"),
        F.avg(LATENCY).alias("avg_latency"),
        *percentile_columns(LATENCY, accuracy, exact),
        F.count_if(is_error()).alias("error_count"),
    ]


def batch_metrics(logs: DataFrame, keys: Sequence[str] = ("service", "level"), accuracy: int = DEFAULT_ACCURACY,
                  exact: bool = False) -> DataFrame:
    """Per (service, level): log_count, avg_latency, p50, p95, p99, error_count.

    Null keys form their own group (bad records are still counted)."""
    return logs.groupBy(*keys).agg(*log_measures(accuracy, exact))


def error_rate(logs: DataFrame, keys: Sequence[str] = ("service",)) -> DataFrame:
    """Per service: total, errors, error_rate = errors / total * 100 (services with no
    rows do not appear, so the positive-total guard holds by construction)."""
    return (
        logs.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(is_error()).alias("errors"))
        .withColumn("error_rate", F.try_divide(F.col("errors").cast("double"), F.col("total")) * F.lit(100.0))
        .filter(F.col("error_rate").isNotNull())
    )


def latency_percentiles(logs: DataFrame, keys: Sequence[str] = ("service",), accuracy: int = DEFAULT_ACCURACY,
                        exact: bool = False) -> DataFrame:
    """Latency percentiles per service over all of its levels.

    The streaming job set one gauge per service from whichever (service, level) row came
    last, an order-dependent result; here the value is defined: the percentile of all
    the service's latencies.  As in the job, a service whose p50 is null (no latency at
    all) is skipped, and a null p95 / p99 becomes 0."""
    return (
        logs.groupBy(*keys)
        .agg(*percentile_columns(LATENCY, accuracy, exact))
        .filter(F.col("p50").isNotNull())
        .withColumn("p95", F.coalesce(F.col("p95"), F.lit(0)))
        .withColumn("p99", F.coalesce(F.col("p99"), F.lit(0)))
    )


def metric_samples(logs: DataFrame, by: Sequence[str] = (), stamp: str | None = None) -> DataFrame:
    """The three gauges of one batch in long form:
    ``(*by, metric, service, level, percentile, value DOUBLE)``; ``by`` adds keys such as
    ``batch_id`` to compute many batches at once, ``stamp`` a column with the largest value
    of that column in the batch.

    Raw logs are read once and aggregated to counts per (service, level, latency);
    latencies are whole milliseconds, so that table is small and percentiles from it are
    exact.  Counts of a service are then ranked by windows, row by row: no list of them is
    ever gathered.  The row that carries the running count across a rank has its latency."""
    by = list(by)
    newest = [F.max(stamp).alias(stamp)] if stamp else []
    counts = logs.groupBy(*by, "service", "level", LATENCY).agg(F.count(F.lit(1)).alias("n"), *newest)
    of_service, of_level = Window.partitionBy(*by, "service"), Window.partitionBy(*by, "service", "level")
    ranked = of_service.orderBy(LATENCY, "level").rowsBetween(Window.unboundedPreceding, -1)
    timed = F.when(F.col(LATENCY).isNotNull(), F.col("n")).otherwise(F.lit(0))
    rows = counts.select(
        *by, "service", "level", LATENCY, *([stamp] if stamp else []),
        timed.alias("_n"),
        F.coalesce(F.sum(timed).over(ranked), F.lit(0)).alias("_below"),
        F.sum(timed).over(of_service).alias("_timed"),
        F.sum("n").over(of_service).alias("_total"),
        F.coalesce(F.sum(F.when(is_error(), F.col("n"))).over(of_service), F.lit(0)).alias("_errors"),
        F.row_number().over(of_service.orderBy(LATENCY, "level")).alias("_i"),
        F.sum("n").over(of_level).alias("_of_level"),
        F.row_number().over(of_level.orderBy(LATENCY)).alias("_j"),
    )
    none = F.lit(None).cast("string")

    def sample(metric: str, level: Column, pct: Column, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), level.alias("level"), pct.alias("percentile"), value.cast("double").alias("value"))

    def crosses(q: float) -> Column:
        at = F.lit(q) * F.col("_timed")
        return (F.col("_below") < at) & (F.col("_below") + F.col("_n") >= at)

    gauges = F.array(
        F.when(F.col("_j") == 1, sample(METRIC_LOGS_PER_BATCH, F.col("level"), none, F.col("_of_level"))),
        F.when(F.col("_i") == 1, sample(METRIC_ERROR_RATE, none, none, F.col("_errors").cast("double") / F.col("_total") * F.lit(100.0))),
        *[F.when(crosses(q), sample(METRIC_LATENCY, none, F.lit(name), F.col(LATENCY))) for name, q in PERCENTILES],
    )
    kept = rows.select(*by, "service", *([F.max(stamp).over(Window.partitionBy(*by)).alias(stamp)] if stamp else []), F.filter(gauges, lambda g: g.isNotNull()).alias("g"))
    out = kept.select(*by, "service", *([stamp] if stamp else []), F.inline("g"))
    return out.select(*by, "metric", "service", "level", "percentile", "value", *([stamp] if stamp else []))
