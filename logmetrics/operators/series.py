"""Gauge time series: the metrics history the streaming job keeps, and the dashboard
operators over it (selection, time range, labels, sums, reducers, resampling, the
push-gateway view).

History rows are ``(batch_id, ts, metric, service, level, percentile, value)``; a
series is one (metric, service, level, percentile) combination.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from logmetrics.config import METRIC_LATENCY, METRIC_LOGS_PER_BATCH
from logmetrics.functions.text import series_label
from logmetrics.functions.time import epoch_micros, from_epoch_micros, interval_micros, ntz_literal
from logmetrics.operators.blocks import BLOCK, blocked_lead
from logmetrics.operators.metrics import metric_samples

SERIES_KEYS = ["metric", "service", "level", "percentile"]


def _micros(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, TimestampType):
        return F.unix_micros(F.col(col))
    return epoch_micros(col)


def replay_history(parsed: DataFrame, trigger: str, time_col: str = "kafka_timestamp") -> DataFrame:
    """Rebuild the metrics history from archived records: records are cut into the
    micro-batches a ``trigger`` would have made by arrival time, and every batch's
    gauges come from one aggregation keyed by batch.
    ``batch_id`` = arrival interval number, ``ts`` = end of the interval (push time)."""
    t_us = interval_micros(trigger)
    us = _micros(parsed, time_col)
    start = us - F.pmod(us, F.lit(t_us))
    batched = parsed.filter(F.col(time_col).isNotNull()).withColumns({
        "batch_id": (start / F.lit(t_us)).cast("long"),
        "ts": from_epoch_micros(start + F.lit(t_us)),
    })
    return metric_samples(batched, by=["batch_id", "ts"])


def select_series(history: DataFrame, **labels) -> DataFrame:
    """Label-equality selector: ``metric{label="v", ...}``; a list selects any of its values."""
    cond = F.lit(True)
    for k, v in labels.items():
        cond = cond & (F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else (F.col(k) == F.lit(v)))
    return history.filter(cond)


def time_range(df: DataFrame, range_: str, as_of=None, ts_col: str = "ts") -> DataFrame:
    """Rows with ``as_of - range <= ts <= as_of``; ``as_of`` defaults to the newest ts."""
    end = df.agg(F.max(ts_col)).scalar() if as_of is None else ntz_literal(as_of)
    start = from_epoch_micros(epoch_micros(end) - F.lit(interval_micros(range_)))
    return df.filter((F.col(ts_col) >= start) & (F.col(ts_col) <= end))


def label_series(history: DataFrame) -> DataFrame:
    """Legend labels the panels render: ``{service} - {level}`` for log counts,
    ``{service} P95`` / ``{service} P99`` for latency."""
    lab = (
        F.when(F.col("metric") == METRIC_LOGS_PER_BATCH, series_label("{service} - {level}"))
        .when((F.col("metric") == METRIC_LATENCY) & (F.col("percentile") == "p95"), series_label("{service} P95"))
        .when((F.col("metric") == METRIC_LATENCY) & (F.col("percentile") == "p99"), series_label("{service} P99"))
    )
    return history.select("ts", "metric", lab.alias("label"), "value").filter(F.col("label").isNotNull())


def sum_by(history: DataFrame, metric: str, by: Sequence[str]) -> DataFrame:
    """``sum(metric) by (by)`` at every ts."""
    return select_series(history, metric=metric).groupBy("ts", *by).agg(F.sum("value").alias("value"))


def reduce_series(history: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Panel reducers per series over the whole range: last non-null, mean, max."""
    return history.groupBy(*keys).agg(
        F.expr("max_by(value, ts) FILTER (WHERE value IS NOT NULL)").alias("last_value"),
        F.avg("value").alias("mean_value"),
        F.max("value").alias("max_value"),
    )


def resample_last(samples: DataFrame, keys: Sequence[str], step: str, lookback: str | None,
                  value: str = "value", start=None, end=None, block: str = BLOCK) -> DataFrame:
    """Value of every series at every step t: the newest sample with
    ``t - lookback < ts <= t`` (no limit when ``lookback`` is None).  Values are not
    carried past the look-back.  ``start`` and ``end`` bound the steps (by default, the
    data); samples too old for any of them are not read further.  Each sample is fanned out to the steps it answers
    (up to the next sample, the look-back or the end of the data), so no grid-to-sample
    join and no per-series window over the whole history is needed."""
    keys = list(keys)
    s_us = interval_micros(step)
    if end is not None:
        samples = samples.filter(F.col("ts") <= ntz_literal(end))
    if start is not None and lookback is not None:
        samples = samples.filter(F.col("ts") > from_epoch_micros(epoch_micros(ntz_literal(start)) - F.lit(interval_micros(lookback))))
    newest = samples.agg(F.max("ts")).scalar() if end is None else ntz_literal(end)
    d = samples.select(*keys, "ts", F.col(value).alias("_v"), epoch_micros("ts").alias("_us"), epoch_micros(newest).alias("_end"))
    end_us = F.col("_end")
    d = blocked_lead(d, keys, "ts", "_us", "_next", block)
    stop = F.coalesce(F.col("_next") - F.lit(1), end_us)
    if lookback is not None:
        stop = F.least(stop, F.col("_us") + F.lit(interval_micros(lookback) - 1))
    stop = F.least(stop, end_us)
    first = F.col("_us") if start is None else F.greatest(F.col("_us"), epoch_micros(ntz_literal(start)))
    lo = first + F.pmod(-first, F.lit(s_us))
    hi = stop - F.pmod(stop, F.lit(s_us))
    return (
        d.select(*keys, "_v", lo.alias("_lo"), hi.alias("_hi"))
        .filter(F.col("_lo") <= F.col("_hi"))
        .select(*keys, "_v", F.explode(F.sequence("_lo", "_hi", F.lit(s_us))).alias("_t"))
        .select(from_epoch_micros(F.col("_t")).alias("ts"), *keys, F.col("_v").alias(value))
    )


def latest_batch(history: DataFrame) -> DataFrame:
    """The push-gateway snapshot: all rows of the newest batch.  Series missing from
    that batch are gone, as when a push replaces the whole group; empty batches are
    never written, so an empty batch leaves the previous snapshot in place.  A stored
    history is partitioned by date, and only the newest date's batches are looked at."""
    if "date" in history.columns:
        history = history.filter(F.col("date") == history.select("date").distinct().agg(F.max("date")).scalar()).drop("date")
    return history.filter(F.col("batch_id") == history.agg(F.max("batch_id")).scalar())


def gateway_scrape(history: DataFrame, step: str, start=None, end=None, block: str = BLOCK) -> DataFrame:
    """What scraping the gateway every ``step`` returns: at each t, the rows of the
    newest batch pushed at or before t.

    Batches are joined with their own rows first and spread over their times last, so a
    long quiet time is not one key of the join.  Batches form one series: its block
    table, one row per day, is ordered in one task."""
    s_us = interval_micros(step)
    batches = history.groupBy("batch_id").agg(F.max("ts").alias("ts"))
    newest = history.agg(F.max("ts")).scalar() if end is None else ntz_literal(end)
    timed = batches.filter(F.col("ts") <= newest).select("batch_id", "ts", epoch_micros("ts").alias("_us"), epoch_micros(newest).alias("_end"))
    b = blocked_lead(timed, [], "ts", "_us", "_next", block)
    stop = F.least(F.coalesce(F.col("_next") - F.lit(1), F.col("_end")), F.col("_end"))
    first = F.col("_us") if start is None else F.greatest(F.col("_us"), epoch_micros(ntz_literal(start)))
    lo = first + F.pmod(-first, F.lit(s_us))
    hi = stop - F.pmod(stop, F.lit(s_us))
    spans = b.select("batch_id", lo.alias("_lo"), hi.alias("_hi")).filter(F.col("_lo") <= F.col("_hi"))
    rows = spans.join(history.drop("ts"), "batch_id")
    return rows.select(F.explode(F.sequence("_lo", "_hi", F.lit(s_us))).alias("_t"), *SERIES_KEYS, "value").select(
        from_epoch_micros(F.col("_t")).alias("ts"), *SERIES_KEYS, "value"
    )
