"""Mergeable latency sketches: quantiles of long times and wide groups from stored state.

``latency_sketches`` keeps, per (labels, step), the log and error counts and a quantile
sketch of the latencies as a column.  ``roll_up`` merges that table upwards - 5 minutes
from 1 minute, days from hours, a service from its levels - and never reads logs again;
``sketch_percentiles`` reads the percentiles off.  The sketch is Spark's KLL sketch: a rank
error of ``rank_error(k)`` at 99 % confidence whatever is merged in whatever order, and no
error in groups of at most ``k`` values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logmetrics.config import PERCENTILES
from logmetrics.functions.time import bucket_start
from logmetrics.operators.metrics import LATENCY, is_error

K = 2048


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch, as its authors measured it."""
    return 2.296 / k**0.9723


def sketch_measures(k: int = K) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("log_count"),
        F.count_if(is_error()).alias("error_count"),
        F.coalesce(F.sum(LATENCY), F.lit(0)).cast("bigint").alias("latency_sum"),
        F.count(LATENCY).alias("latency_count"),
        F.kll_sketch_agg_bigint(F.col(LATENCY).cast("bigint"), k).alias("latency"),
    ]


def merged_measures(k: int = K) -> list[Column]:
    """The measures of a group, from those of its parts."""
    sums = ("log_count", "error_count", "latency_sum", "latency_count")
    return [*[F.sum(c).cast("bigint").alias(c) for c in sums], F.kll_merge_agg_bigint("latency", k).alias("latency")]


def latency_sketches(logs: DataFrame, step: str, keys: Sequence[str] = ("service", "level"), time_col: str = "event_ts", k: int = K) -> DataFrame:
    """(window_start, labels, measures) from raw logs; rows without an event time are in no
    window."""
    return logs.filter(F.col(time_col).isNotNull()).groupBy(bucket_start(time_col, step).alias("window_start"), *keys).agg(*sketch_measures(k))


def roll_up(sketches: DataFrame, step: str | None = None, keys: Sequence[str] = ("service", "level"), k: int = K) -> DataFrame:
    """Sketches of longer steps (a multiple of theirs; None for all times) and of fewer
    labels.  Partial merges run before the shuffle, so a hot group is one buffer a task."""
    time = [bucket_start("window_start", step).alias("window_start")] if step else []
    return sketches.groupBy(*time, *keys).agg(*merged_measures(k))


def sketch_percentiles(sketches: DataFrame) -> DataFrame:
    """Counts, mean and percentiles in place of the sketch; null without a latency."""
    some = F.col("latency_count") > 0
    at = [F.when(some, F.kll_sketch_get_quantile_bigint("latency", F.lit(float(q)))).cast("int").alias(name) for name, q in PERCENTILES]
    kept = [c for c in sketches.columns if c not in ("latency", "latency_sum", "latency_count")]
    return sketches.select(*kept, F.try_divide(F.col("latency_sum").cast("double"), F.col("latency_count")).alias("avg_latency"), *at)


def rank_errors(logs: DataFrame, found: DataFrame, keys: Sequence[str] = ("service", "level"), value: str = LATENCY) -> DataFrame:
    """How far the percentiles of ``found`` (labels, p50, p95, p99) are off by rank:
    (labels, percentile, n, rank_error).  Zero if a value's ranks enclose the percentile."""
    keys = list(keys)
    counts = logs.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    asked = F.array(*[F.struct(F.lit(name).alias("percentile"), F.lit(q).alias("_q"), F.col(name).alias("_p")) for name, q in PERCENTILES])
    asked = found.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.inline(asked))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    sums = counts.join(asked, same).groupBy(*keys, "percentile", "_q").agg(
        F.sum("_n").alias("n"),
        F.sum(F.when(F.col("_v") < F.col("_p"), F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("_v") <= F.col("_p"), F.col("_n")).otherwise(0)).alias("_upto"),
    )
    off = F.greatest(F.lit(0.0), F.col("_below") / F.col("n") - F.col("_q"), F.col("_q") - F.col("_upto") / F.col("n"))
    return sums.select(*keys, "percentile", "n", off.alias("rank_error"))
