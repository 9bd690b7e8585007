"""Rolled-up sketches: exact in small groups, within the stated error in large ones, in any
order of merging, without reading logs again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logmetrics.operators import metrics as M
from logmetrics.operators import sketches as SK

T = dt.datetime(2024, 1, 1)


def logs_of(spark, n):
    """A hot service, a skewed value distribution, nulls and a service without latencies."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 == 1, "none").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("service"),
        F.when(F.col("id") % 7 == 0, "ERROR").otherwise("INFO").alias("level"),
        F.when((F.col("id") % 11 == 0) | ((F.col("id") % 97 == 1) & (F.col("id") % 3 > 0)), None).otherwise(F.pow(F.rand(5), 4) * 100000).cast("int").alias("response_time_ms"),
        F.timestamp_add("SECOND", (F.col("id") * 7919) % 200000, F.lit(T).cast("timestamp_ntz")).alias("event_ts"),
    )


@pytest.fixture(scope="module")
def stored(spark):
    from logmetrics.session import materialize

    logs = materialize(logs_of(spark, 120_000), "t-sketch-logs")
    return logs, materialize(SK.latency_sketches(logs, "1 minute"), "t-sketches")


def test_large_groups_stay_within_the_stated_error(stored):
    logs, minutes = stored
    days = SK.roll_up(SK.roll_up(minutes, "1 hour"), "1 day")
    for found, keys in ((SK.roll_up(days), ["service", "level"]), (SK.roll_up(days, None, ["service"]), ["service"])):
        errors = SK.rank_errors(logs, SK.sketch_percentiles(found), keys).collect()
        assert max(r.n for r in errors) > 10 * SK.K
        assert all(r.rank_error <= 2 * SK.rank_error() for r in errors)
        assert {r.service for r in errors} == {"hot", "s0", "s1", "s2", "s3", "s4"}
    approx = SK.rank_errors(logs, M.batch_metrics(logs)).collect()
    assert all(r.rank_error <= 1e-4 for r in approx)


def test_small_groups_are_exact_and_sums_always(stored):
    logs, minutes = stored
    hours = SK.sketch_percentiles(SK.roll_up(minutes, "1 hour")).drop("avg_latency")
    exact = logs.groupBy(F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("window_start"), "service", "level").agg(
        F.count("*").alias("log_count"), F.count_if(M.is_error()).alias("error_count"), *M.percentile_columns(exact=True))
    assert hours.exceptAll(exact).count() == 0 and exact.exceptAll(hours).count() == 0


def test_roll_ups_read_the_sketches_alone(stored):
    _, minutes = stored
    plan = SK.sketch_percentiles(SK.roll_up(minutes, "1 day", ["service"]))
    assert plan.inputFiles() and set(plan.inputFiles()) == set(minutes.inputFiles())


def test_no_latency_no_rows_and_wrong_ranks(spark):
    empty = logs_of(spark, 0)
    assert SK.sketch_percentiles(SK.roll_up(SK.latency_sketches(empty, "1 minute"))).count() == 0
    none = spark.createDataFrame([("a", "x", None, T), (None, None, 5, T), (None, None, 5, None)], "service string, level string, response_time_ms int, event_ts timestamp_ntz")
    rows = {r.service: r for r in SK.sketch_percentiles(SK.roll_up(SK.latency_sketches(none, "1 minute"))).collect()}
    assert rows["a"].p50 is None and rows["a"].avg_latency is None and rows["a"].log_count == 1
    assert (rows[None].p50, rows[None].log_count) == (5, 1)
    found = spark.createDataFrame([("a", 1, 1, 9)], "service string, p50 int, p95 int, p99 int")
    ten = spark.range(1, 11).select(F.lit("a").alias("service"), F.col("id").cast("int").alias("response_time_ms"))
    off = {r.percentile: round(r.rank_error, 6) for r in SK.rank_errors(ten, found, ["service"]).collect()}
    assert off == {"p50": 0.4, "p95": 0.85, "p99": 0.09}
