"""Cumulative histograms and ``histogram_quantile``.

* ``histogram``: cumulative ``le`` buckets (upper bound inclusive) plus sum and count,
  computed in one aggregation with one conditional count per bound - a single pass,
  partial-aggregated, no second window over the buckets.
* ``histogram_samples``: the bucket counters as scraped every step (dense grid,
  running sums), i.e. ``<name>_bucket{le}`` over time.
* ``histogram_quantile``: the quantile per (series, t) from bucket rates with linear
  interpolation inside the bucket.  Buckets of one (series, t) are a fixed, small
  set (the configured bounds), gathered into one sorted array and evaluated with
  higher-order functions in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logmetrics.functions.time import bucket_end, from_epoch_micros
from logmetrics.operators.blocks import BLOCK
from logmetrics.operators.counters import change_points, cumulative_samples, evaluated_steps, extrapolated, label_cols

INF = float("inf")


def _bucket_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    return [F.count_if(value <= F.lit(float(b))).alias(f"b{i}") for i, b in enumerate(bounds)] + [
        F.count(value).alias(f"b{len(bounds)}")
    ]


def histogram(df: DataFrame, value: Column, bounds: Sequence[float], keys: Sequence[str] = (), scale: float | None = None) -> DataFrame:
    """(keys, le, bucket_count, sum_value, count_value); ``le`` = +Infinity for the last.

    With ``scale``, ``value`` counts whole units (such as milliseconds) of which ``scale``
    make one unit of the bounds: the sum is taken over whole numbers and divided once,
    so it doesn't depend on the order of merging."""
    keys = list(keys)
    scaled = value if scale is None else value / F.lit(float(scale))
    total = F.sum(value) if scale is None else F.sum(value) / F.lit(float(scale))
    agg = df.groupBy(*keys).agg(*_bucket_counts(scaled, bounds), total.alias("sum_value"),
                                F.count(value).alias("count_value"))
    les = [*map(float, bounds), INF]
    pairs = F.array(*[F.struct(F.lit(le).alias("le"), F.col(f"b{i}").alias("bucket_count")) for i, le in
                      enumerate(les)])
    return agg.select(*keys, F.inline(pairs), "sum_value", "count_value")


def bucket_step_counts(df: DataFrame, value: Column, bounds: Sequence[float], step: str, keys: Sequence[str] = (),
                       time_col: str = "event_ts") -> DataFrame:
    """Cumulative bucket counts per step, one column per bucket: (keys, ts, b0, b1, ..).
    All buckets of a series start and are scraped together, so they are one row."""
    return df.filter(F.col(time_col).isNotNull()).groupBy(*label_cols(list(keys)), bucket_end(time_col, step).alias("ts")).agg(*_bucket_counts(value, bounds))


def histogram_samples(df: DataFrame, value: Column, bounds: Sequence[float], step: str, keys: Sequence[str] = (),
                      time_col: str = "event_ts", start=None, end=None, block: str = BLOCK) -> DataFrame:
    """Bucket counters as scraped at every step: (keys, ts, b0, b1, ..)."""
    names = [f"b{i}" for i in range(len(bounds) + 1)]
    counts = bucket_step_counts(df, value, bounds, step, keys, time_col)
    return cumulative_samples(counts, list(keys), step, names, names, start, end, block)


def quantile_from_buckets(df: DataFrame, q: float, buckets: str, out: str) -> DataFrame:
    """Add ``out`` = the q-quantile of ``buckets`` (array of struct(le, v) sorted by le).

    NULL (the exposition's NaN) when there is no +Inf bucket, fewer than two buckets or
    no observations.  Counts are first made monotonic (running max).  Each
    intermediate is its own projection so the array work is done once per row."""
    bk = F.col(buckets)
    mono = F.transform(
        bk,
        lambda x, i: F.struct(
            x["le"].alias("le"),
            F.array_max(F.transform(F.slice(bk, 1, i + 1), lambda y: y["v"])).alias("v"),
        ),
    )
    d = df.withColumn("_m", mono).withColumn("_n", F.size(bk)).withColumn("_inf", F.element_at(bk, -1)["le"])
    d = d.withColumn("_rank", F.lit(float(q)) * F.element_at(F.col("_m"), -1)["v"])
    # first bucket (0-based) among the finite ones whose count reaches the rank
    d = d.withColumn("_b", F.size(F.filter(F.slice(F.col("_m"), 1, F.col("_n") - 1),
                                           lambda x: x["v"] < F.col("_rank"))))
    d = d.withColumn("_cur", F.element_at(F.col("_m"), F.col("_b") + 1)).withColumn(
        "_prev", F.when(F.col("_b") > 0, F.element_at(F.col("_m"), F.col("_b"))))
    prev_le = F.coalesce(F.col("_prev")["le"], F.lit(0.0))
    prev_v = F.coalesce(F.col("_prev")["v"], F.lit(0.0))
    cur = F.col("_cur")
    interp = prev_le + (cur["le"] - prev_le) * F.try_divide(F.col("_rank") - prev_v, cur["v"] - prev_v)
    total = F.element_at(F.col("_m"), -1)["v"]
    nan = (F.col("_n") < 2) | (F.col("_inf") != F.lit(INF)) | (total == 0)
    res = (
        F.when(nan, F.lit(None).cast("double"))
        .when(F.col("_b") == F.col("_n") - 1, F.element_at(F.col("_m"), -2)["le"])
        .when((F.col("_b") == 0) & (cur["le"] <= 0), cur["le"])
        .otherwise(interp)
    )
    return d.withColumn(out, res).drop("_m", "_n", "_inf", "_rank", "_b", "_cur", "_prev")


def histogram_quantile(q: float, bucket_rates: DataFrame, keys: Sequence[str], value: str = "rate",
                       out: str = "value") -> DataFrame:
    """``histogram_quantile(q, <bucket rates>)`` per (keys, ts)."""
    keys = list(keys)
    g = bucket_rates.groupBy(*keys, "ts").agg(
        F.array_sort(F.collect_list(F.struct(F.col("le").alias("le"), F.col(value).alias("v")))).alias("_bk")
    )
    return quantile_from_buckets(g, q, "_bk", out).select(*keys, "ts", out)


def latency_quantile_ms(df: DataFrame, q: float, step: str, range_: str, keys: Sequence[str], bounds: Sequence[float],
                        latency_ms: str = "response_time_ms", start=None, end=None) -> DataFrame:
    """``histogram_quantile(q, rate(latency_seconds_bucket[range])) * 1000`` from raw logs,
    at every step from ``start`` to ``end``.

    Quantiles are worked out where a range holds logs; at all other steps of a series no
    bucket has a rate, so the value is NULL, and those steps are only laid out."""
    keys = list(keys)
    seconds = F.col(latency_ms) / F.lit(1000.0)
    names = [f"b{i}" for i in range(len(bounds) + 1)]
    counts = bucket_step_counts(df, seconds, bounds, step, keys)
    points, starts, last = change_points(counts, keys, range_, step, names, names, start, end)
    pairs = F.array(*[F.struct(F.lit(le).alias("le"), extrapolated(range_, True, b).alias("v")) for le, b in zip([*map(float, bounds), INF], names, strict=True)])
    rates = points.select(*keys, from_epoch_micros(F.col("t_us")).alias("ts"), pairs.alias("_bk"))
    qs = quantile_from_buckets(rates, q, "_bk", "_q")
    found = qs.select(*keys, "ts", (F.col("_q") * F.lit(1000.0)).alias("value_ms"))
    steps = evaluated_steps(starts, keys, last, step, start).withColumn("value_ms", F.lit(None).cast("double"))
    return found.unionByName(steps).groupBy(*keys, "ts").agg(F.max("value_ms").alias("value_ms"))
