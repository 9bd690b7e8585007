"""Event-time windows over logs: tumbling per-window metrics, short error counts,
windowed error-rate anomalies and ingest delay.

Tumbling windows are a plain ``groupBy(window(...))``: each row lands in one window,
so the plan is scan -> partial aggregate -> hash exchange -> final aggregate, the same
shape as the per-batch metrics.  Rows without an event time fall out of ``window()``;
``unwindowed_rows`` counts them so nothing disappears silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from logmetrics.config import DEFAULT_ACCURACY, DEFAULT_ANOMALY_THRESHOLD
from logmetrics.functions.time import epoch_micros, parse_iso_utc
from logmetrics.operators.metrics import is_error, log_measures, percentile_columns


def _flat(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *measures
    )


def windowed_metrics(logs: DataFrame, duration: str, keys: Sequence[str] = ("service", "level"),
                     time_col: str = "event_ts", accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    """Per tumbling window and (service, level): the per-batch measures."""
    agg = logs.groupBy(F.window(time_col, duration).alias("window"), *keys).agg(*log_measures(accuracy, exact))
    return _flat(agg, keys, ["log_count", "avg_latency", "p50", "p95", "p99", "error_count"])


def error_counts(logs: DataFrame, duration: str = "5 seconds", keys: Sequence[str] = ("service",),
                 time_col: str = "event_ts") -> DataFrame:
    """Error logs per short tumbling window (only windows that have errors).  The level
    filter runs before the aggregation and reaches the scan when the level is a
    stored column."""
    agg = logs.filter(is_error()).groupBy(F.window(time_col, duration).alias("window"), *keys).agg(
        F.count(F.lit(1)).alias("errors")
    )
    return _flat(agg, keys, ["errors"])


def error_anomalies(logs: DataFrame, duration: str, threshold: float = DEFAULT_ANOMALY_THRESHOLD,
                    keys: Sequence[str] = ("service",), time_col: str = "event_ts") -> DataFrame:
    """Windows whose error rate (percent) is above ``threshold``."""
    agg = logs.groupBy(F.window(time_col, duration).alias("window"), *keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(is_error()).alias("errors")
    )
    rate = F.try_divide(F.col("errors").cast("double"), F.col("total")) * F.lit(100.0)
    return _flat(agg.withColumn("error_rate", rate), keys, ["total", "errors", "error_rate"]).filter(
        F.col("error_rate") > F.lit(float(threshold))
    )


def unwindowed_rows(logs: DataFrame, time_col: str = "event_ts") -> DataFrame:
    """Rows no window can hold (null event time), counted per service."""
    return logs.filter(F.col(time_col).isNull()).groupBy("service").agg(F.count(F.lit(1)).alias("rows"))


def with_event_time(parsed: DataFrame, col: str = "event_ts") -> DataFrame:
    """Event time from the log's own ``timestamp`` string (NTZ, UTC wall clock); null when
    the string does not parse."""
    return parsed.withColumn(col, parse_iso_utc("timestamp"))


def _instant_micros(df: DataFrame, col: str):
    """Epoch micros of a timestamp column of either kind (NTZ is read as UTC)."""
    if isinstance(df.schema[col].dataType, TimestampType):
        return F.unix_micros(F.col(col))
    return epoch_micros(col)


def ingest_delay(parsed: DataFrame, keys: Sequence[str] = ("service",), accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    """Delay from the log's own timestamp to its arrival on the topic, in ms: samples,
    mean, p50 / p95 / p99 and max per service, and ``unparsed``, the rows whose
    timestamp (or arrival) is missing or unreadable and so have no delay.

    Aggregates integer microseconds and scales at the end, so sums are exact and the
    result does not depend on the order partial aggregates are merged in."""
    event_us = epoch_micros(parse_iso_utc("timestamp"))
    delay_us = _instant_micros(parsed, "kafka_timestamp") - event_us
    d = parsed.select(*keys, delay_us.alias("delay_us"))
    ms = F.lit(1000.0)
    pcts = percentile_columns("delay_us", accuracy, exact, prefix="delay_", kind="bigint")
    agg = d.groupBy(*keys).agg(
        F.count("delay_us").alias("samples"),
        F.count_if(F.col("delay_us").isNull()).alias("unparsed"),
        F.avg("delay_us").alias("avg_us"),
        *pcts,
        F.max("delay_us").alias("max_us"),
    )
    return agg.select(
        *keys, "samples", "unparsed", (F.col("avg_us") / ms).alias("avg_delay_ms"),
        *[(F.col(f"delay_{n}") / ms).alias(f"delay_{n}_ms") for n in ("p50", "p95", "p99")],
        (F.col("max_us") / ms).alias("max_delay_ms"),
    )
