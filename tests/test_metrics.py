from pyspark.sql import functions as F

from logmetrics.operators import metrics as M

SCHEMA = "service string, level string, response_time_ms int"


def test_batch_metrics_nulls(spark):
    df = spark.createDataFrame(
        [("a", "ERROR", None), (None, None, 10), (None, None, 30), ("a", "INFO", 5), ("a", "INFO", 7)], SCHEMA)
    out = {(r.service, r.level): r for r in M.batch_metrics(df).collect()}
    e = out[("a", "ERROR")]
    assert (e.log_count, e.avg_latency, e.p50, e.error_count) == (1, None, None, 1)
    n = out[(None, None)]
    assert (n.log_count, n.avg_latency, n.p50, n.p99, n.error_count) == (2, 20.0, 10, 30, 0)
    i = out[("a", "INFO")]
    assert (i.log_count, i.p50, i.p95) == (2, 5, 7)


def test_error_rate_and_latency(spark):
    df = spark.createDataFrame(
        [("a", "ERROR", None), ("a", "INFO", 10), ("a", "WARN", 20), ("a", "error", 30), ("b", "ERROR", None)],
        SCHEMA)
    rates = {r.service: (r.total, r.errors, r.error_rate) for r in M.error_rate(df).collect()}
    assert rates == {"a": (4, 1, 25.0), "b": (1, 1, 100.0)}
    lat = {r.service: (r.p50, r.p95, r.p99) for r in M.latency_percentiles(df).collect()}
    assert lat == {"a": (20, 30, 30)}  # b has no latency at all: skipped


def test_metric_samples_long_form(spark):
    df = spark.createDataFrame([("a", "ERROR", 100), ("a", "INFO", 10), ("b", "INFO", None)], SCHEMA)
    rows = {(r.metric, r.service, r.level, r.percentile): r.value for r in M.metric_samples(df).collect()}
    assert rows[("spark_logs_per_batch", "a", "ERROR", None)] == 1.0
    assert rows[("spark_error_rate", "a", None, None)] == 50.0
    assert rows[("spark_error_rate", "b", None, None)] == 0.0
    assert rows[("spark_latency_ms", "a", None, "p50")] == 10.0
    assert ("spark_latency_ms", "b", None, "p50") not in rows
    assert len(rows) == 3 + 2 + 3


def test_exact_percentiles(spark):
    df = spark.range(1, 1001).select(F.lit("s").alias("service"), F.lit("INFO").alias("level"),
                                     F.col("id").cast("int").alias("response_time_ms"))
    r = M.batch_metrics(df, exact=True).collect()[0]
    assert (r.p50, r.p95, r.p99) == (500, 950, 990)
