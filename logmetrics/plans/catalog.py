"""The registry of named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (``events`` through the fixture ``logs`` view)
over their whole extent, with the dashboard's own parameters: 15 s scrapes, 1 m and 5 m
ranges, 5 m look-back, 1 s micro-batches.  Queries whose result a sum of doubles in some
order decides are rounded to 9 significant digits at the very end (``significant``);
the operators behind them are not.  Percentiles are exact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmetrics.config import DASHBOARD_RANGE, DEFAULT_ACCURACY, DEFAULT_LOOKBACK, DEFAULT_TRIGGER, LOG_COLUMNS, SCRAPE_INTERVAL
from logmetrics.functions.text import payload_bytes, significant
from logmetrics.functions.time import bucket_end, epoch_micros
from logmetrics.operators import metrics as M
from logmetrics.sources.codec import parse_logs, wire_records
from logmetrics.sources.fixtures import load_logs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn

    return deco


def parsed_logs(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Fixture logs sent through the wire codec and decoded again (encode -> parse),
    i.e. what the streaming job sees; ``event_id`` / ``event_ts`` ride along."""
    wire = wire_records(load_logs(spark, sf_dir), keep=["event_id", "event_ts"])
    return parse_logs(wire, columns=columns, keep=["event_id", "event_ts"])


# --- sources / codec ---------------------------------------------------------------


@register("parse_logs")
def q_parse_logs(spark, sf_dir):
    return parsed_logs(spark, sf_dir).select("event_id", *LOG_COLUMNS, "kafka_timestamp")


@register("encode_logs")
def q_encode_logs(spark, sf_dir):
    logs = load_logs(spark, sf_dir)
    return logs.select(
        "event_id",
        F.to_json(F.struct(*[F.col(c) for c in LOG_COLUMNS])).alias("payload"),
        payload_bytes(LOG_COLUMNS).alias("payload_bytes"),
    )


# --- per-batch metrics -------------------------------------------------------------


@register("batch_metrics")
def q_batch_metrics(spark, sf_dir):
    return M.batch_metrics(parsed_logs(spark, sf_dir, columns=["service", "level", "response_time_ms"]), exact=True)


@register("error_rate")
def q_error_rate(spark, sf_dir):
    return M.error_rate(load_logs(spark, sf_dir))


@register("error_count")
def q_error_count(spark, sf_dir):
    return load_logs(spark, sf_dir).groupBy("service", "level").agg(F.count_if(M.is_error()).alias("error_count"))


@register("latency_percentiles")
def q_latency_percentiles(spark, sf_dir):
    return M.latency_percentiles(load_logs(spark, sf_dir), exact=True)


@register("percentiles_exact")
def q_percentiles_exact(spark, sf_dir):
    logs = load_logs(spark, sf_dir)
    return logs.groupBy("service", "level").agg(*M.percentile_columns(exact=True))


@register("metric_samples")
def q_metric_samples(spark, sf_dir):
    return M.metric_samples(load_logs(spark, sf_dir))


# --- event-time windows, anomalies, delay, daily report, bands ---------------------

from logmetrics.operators import bands as B  # noqa: E402
from logmetrics.operators import reports as R  # noqa: E402
from logmetrics.operators import windows as W  # noqa: E402

# The dashboard's error-rate red band is the default anomaly threshold; the window is
# an hour because the fixture has a few events per minute.
ANOMALY_WINDOW = "1 hour"


@register("window_1m")
def q_window_1m(spark, sf_dir):
    return W.windowed_metrics(load_logs(spark, sf_dir), "1 minute", exact=True)


@register("window_5m")
def q_window_5m(spark, sf_dir):
    return W.windowed_metrics(load_logs(spark, sf_dir), "5 minutes", exact=True)


@register("errors_5s")
def q_errors_5s(spark, sf_dir):
    return W.error_counts(load_logs(spark, sf_dir), "5 seconds")


@register("error_anomalies")
def q_error_anomalies(spark, sf_dir):
    return W.error_anomalies(load_logs(spark, sf_dir), ANOMALY_WINDOW)


@register("ingest_delay")
def q_ingest_delay(spark, sf_dir):
    """Some records carry a timestamp that can't be read, some one without a fraction or
    with an offset; the first kind is counted, the others are read."""
    e = F.col("event_id")
    stamp = (
        F.when(e % 97 == 1, F.lit("bad"))
        .when(e % 97 == 2, F.lit(None).cast("string"))
        .when(e % 97 == 3, F.concat(F.substring("timestamp", 1, 19), F.lit("Z")))
        .when(e % 97 == 4, F.regexp_replace("timestamp", "Z$", "+07:00"))
        .otherwise(F.col("timestamp"))
    )
    wire = wire_records(load_logs(spark, sf_dir).withColumn("timestamp", stamp))
    return W.ingest_delay(parse_logs(wire, columns=["timestamp", "service"]), exact=True)


@register("unwindowed_rows")
def q_unwindowed_rows(spark, sf_dir):
    """Records that no event-time window can hold, per service."""
    bad = F.when(F.col("event_id") % 89 == 0, F.lit("2024-13-01T00:00:00Z")).otherwise(F.col("timestamp"))
    wire = wire_records(load_logs(spark, sf_dir).withColumn("timestamp", bad))
    return W.unwindowed_rows(W.with_event_time(parse_logs(wire, columns=["timestamp", "service"])))


@register("daily_report")
def q_daily_report(spark, sf_dir):
    return R.daily_report(load_logs(spark, sf_dir), exact=True)


@register("threshold_band")
def q_threshold_band(spark, sf_dir):
    """Error rate (%) and p95 latency per service, and peak logs per second over all, with
    their dashboard bands."""
    agg = load_logs(spark, sf_dir).groupBy("service").agg(
        (F.try_divide(F.count_if(M.is_error()).cast("double"), F.count(F.lit(1))) * F.lit(100.0)).alias("err"),
        *M.percentile_columns("response_time_ms", exact=True),
    )
    rows = F.array(
        F.struct(F.lit("error_rate_pct").alias("panel"), F.col("err").alias("value"),
                 B.band(F.col("err"), B.THRESHOLDS["error_rate_pct"]).alias("band")),
        F.when(F.col("p50").isNotNull(), F.struct(
            F.lit("latency_ms").alias("panel"), F.col("p95").cast("double").alias("value"),
            B.band(F.col("p95").cast("double"), B.THRESHOLDS["latency_ms"]).alias("band"))),
    )
    per_service = agg.select("service", F.inline(F.filter(rows, lambda r: r.isNotNull())))
    per_second = load_logs(spark, sf_dir).groupBy(F.window("event_ts", "1 second")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    peak = per_second.agg(F.max("n").alias("value")).select(F.lit(None).cast("string").alias("service"), F.lit("logs_per_second").alias("panel"), "value")
    return per_service.unionByName(B.threshold_band(peak, "value", "logs_per_second"))


# --- mergeable sketches ------------------------------------------------------------

from logmetrics.operators import sketches as SK  # noqa: E402
from logmetrics.session import materialize  # noqa: E402


def minute_sketches(spark, sf_dir):
    """The stored 1-minute sketches, which all roll-ups below start from."""
    return materialize(SK.latency_sketches(load_logs(spark, sf_dir), "1 minute"), "minute-sketches")


@register("sketch_5m")
def q_sketch_5m(spark, sf_dir):
    return SK.sketch_percentiles(SK.roll_up(minute_sketches(spark, sf_dir), "5 minutes"))


@register("sketch_day")
def q_sketch_day(spark, sf_dir):
    """Days from hours from minutes."""
    hours = SK.roll_up(minute_sketches(spark, sf_dir), "1 hour")
    return SK.sketch_percentiles(SK.roll_up(hours, "1 day"))


@register("sketch_service")
def q_sketch_service(spark, sf_dir):
    """A service's days from its levels' days."""
    days = SK.roll_up(minute_sketches(spark, sf_dir), "1 day")
    return SK.sketch_percentiles(SK.roll_up(days, "1 day", ["service"]))


@register("percentile_rank_error")
def q_percentile_rank_error(spark, sf_dir):
    """Both approximations on their default path, over all logs per (service, level), held
    against exact ranks: within the error each promises."""
    logs = load_logs(spark, sf_dir)
    sketched = SK.sketch_percentiles(SK.roll_up(minute_sketches(spark, sf_dir)))
    out = None
    for method, found, bound in (("percentile_approx", M.batch_metrics(logs), 1 / DEFAULT_ACCURACY), ("sketch", sketched, 2 * SK.rank_error())):
        errors = SK.rank_errors(logs, found).select(F.lit(method).alias("method"), "service", "level", "percentile", "n", (F.col("rank_error") <= bound).alias("within"))
        out = errors if out is None else out.unionByName(errors)
    return out


# --- counters, rates, sums over series ---------------------------------------------

from logmetrics.operators import counters as C  # noqa: E402

SHORT_RANGE, LONG_RANGE = "1 minute", "5 minutes"
SERIES = ("service", "level")


def fixture_rates(spark, sf_dir, range_, keys=SERIES):
    return C.log_rates(load_logs(spark, sf_dir), range_, SCRAPE_INTERVAL, keys)


def rounded(df, *cols):
    return df.withColumns({c: significant(F.col(c)) for c in cols})


@register("counter_samples")
def q_counter_samples(spark, sf_dir):
    return C.counter_samples(load_logs(spark, sf_dir), SCRAPE_INTERVAL, ["service"])


@register("counter_increase")
def q_counter_increase(spark, sf_dir):
    return C.log_increase(load_logs(spark, sf_dir), SHORT_RANGE, SCRAPE_INTERVAL, ["level"])


@register("counter_rate")
def q_counter_rate(spark, sf_dir):
    return fixture_rates(spark, sf_dir, SHORT_RANGE, ["service"])


@register("counter_samples_series")
def q_counter_samples_series(spark, sf_dir):
    return C.counter_samples(load_logs(spark, sf_dir), SCRAPE_INTERVAL, SERIES)


@register("counter_increase_series")
def q_counter_increase_series(spark, sf_dir):
    return C.log_increase(load_logs(spark, sf_dir), SHORT_RANGE, SCRAPE_INTERVAL, SERIES)


@register("counter_rate_series")
def q_counter_rate_series(spark, sf_dir):
    return fixture_rates(spark, sf_dir, SHORT_RANGE)


@register("logs_per_second")
def q_logs_per_second(spark, sf_dir):
    return rounded(C.rate_sums(load_logs(spark, sf_dir), SHORT_RANGE, SCRAPE_INTERVAL), "value")


@register("rate_by_service")
def q_rate_by_service(spark, sf_dir):
    return rounded(C.rate_sums(load_logs(spark, sf_dir), SHORT_RANGE, SCRAPE_INTERVAL, ["service"]), "value")


@register("rate_by_level")
def q_rate_by_level(spark, sf_dir):
    return rounded(C.rate_sums(load_logs(spark, sf_dir), SHORT_RANGE, SCRAPE_INTERVAL, ["level"]), "value")


@register("error_rate_5m")
def q_error_rate_5m(spark, sf_dir):
    return rounded(C.rate_ratio(load_logs(spark, sf_dir), LONG_RANGE, SCRAPE_INTERVAL), "value")


@register("event_rate_1m")
def q_event_rate_1m(spark, sf_dir):
    return C.event_rate(load_logs(spark, sf_dir), "1 minute", "15 seconds", keys=["service"])


@register("event_rate_5m")
def q_event_rate_5m(spark, sf_dir):
    return C.event_rate(load_logs(spark, sf_dir), "5 minutes", "1 minute", keys=["level"])


def counter_totals(spark, sf_dir):
    """The counter's last value per series: a counter at the end of the data is the number
    of its logs, so no series of samples is needed."""
    steps = C.step_counts(load_logs(spark, sf_dir), SCRAPE_INTERVAL, SERIES)
    return steps.groupBy(*SERIES).agg(F.sum("n").cast("double").alias("value")), steps


@register("last_value_gauge")
def q_last_value_gauge(spark, sf_dir):
    totals, steps = counter_totals(spark, sf_dir)
    return totals.select(*SERIES, steps.agg(F.max("ts")).scalar().alias("ts"), "value")


@register("total_logs")
def q_total_logs(spark, sf_dir):
    return counter_totals(spark, sf_dir)[0].agg(F.sum("value").alias("total_logs"))


# --- metrics history and the dashboard's gauge series ------------------------------

from logmetrics.config import METRIC_LATENCY, METRIC_LOGS_PER_BATCH  # noqa: E402
from logmetrics.operators import series as S  # noqa: E402


def fixture_history(spark, sf_dir, stored=False):
    """The metrics history table, as the streaming job would have stored it; ``stored``
    for queries that read it more than once."""
    arrived = load_logs(spark, sf_dir).withColumn("kafka_timestamp", bucket_end("event_ts", "1 second"))
    h = S.replay_history(arrived, DEFAULT_TRIGGER)
    return materialize(h, "metrics-history") if stored else h


@register("metrics_history")
def q_metrics_history(spark, sf_dir):
    return fixture_history(spark, sf_dir)


@register("metrics_latest")
def q_metrics_latest(spark, sf_dir):
    return S.latest_batch(fixture_history(spark, sf_dir, stored=True))


@register("select_series")
def q_select_series(spark, sf_dir):
    h = S.select_series(fixture_history(spark, sf_dir), metric=METRIC_LATENCY, percentile=["p95", "p99"])
    return h.select("ts", "service", "percentile", "value")


@register("time_range")
def q_time_range(spark, sf_dir):
    return S.time_range(fixture_history(spark, sf_dir, stored=True), DASHBOARD_RANGE)


@register("series_label")
def q_series_label(spark, sf_dir):
    return S.label_series(fixture_history(spark, sf_dir))


@register("logs_per_batch_by_service")
def q_logs_per_batch_by_service(spark, sf_dir):
    return S.sum_by(fixture_history(spark, sf_dir), METRIC_LOGS_PER_BATCH, ["service"])


@register("series_reduce")
def q_series_reduce(spark, sf_dir):
    return rounded(S.reduce_series(fixture_history(spark, sf_dir)), "mean_value")


@register("resample_last")
def q_resample_last(spark, sf_dir):
    h = S.select_series(fixture_history(spark, sf_dir, stored=True), metric=METRIC_LOGS_PER_BATCH)
    return S.resample_last(h, ["service", "level"], SCRAPE_INTERVAL, DEFAULT_LOOKBACK)


@register("gateway_scrape")
def q_gateway_scrape(spark, sf_dir):
    return S.gateway_scrape(fixture_history(spark, sf_dir, stored=True), SCRAPE_INTERVAL)


# --- histograms -------------------------------------------------------------------------

from logmetrics.config import LATENCY_BUCKETS, SIZE_BUCKETS  # noqa: E402
from logmetrics.operators import histograms as H  # noqa: E402


@register("size_histogram")
def q_size_histogram(spark, sf_dir):
    return H.histogram(load_logs(spark, sf_dir), payload_bytes(LOG_COLUMNS), SIZE_BUCKETS)


@register("latency_histogram")
def q_latency_histogram(spark, sf_dir):
    logs = load_logs(spark, sf_dir)
    return H.histogram(logs, F.col("response_time_ms"), LATENCY_BUCKETS, keys=["service"], scale=1000.0)


@register("histogram_quantile")
def q_histogram_quantile(spark, sf_dir):
    return H.latency_quantile_ms(load_logs(spark, sf_dir), 0.95, SCRAPE_INTERVAL, LONG_RANGE, ["service"],
                                 LATENCY_BUCKETS)


# --- streaming, archive -------------------------------------------------------------------

from logmetrics.session import scratch_path  # noqa: E402
from logmetrics.sources import archive as A  # noqa: E402
from logmetrics.sources import lifecycle as LC  # noqa: E402
from logmetrics.sources import versions as V  # noqa: E402
from logmetrics.sources.streams import read_log_stream  # noqa: E402
from logmetrics.streaming import job as J  # noqa: E402
from logmetrics.streaming import ledger as LG  # noqa: E402
from logmetrics.streaming import offsets as OF  # noqa: E402
from logmetrics.streaming import panels as PN  # noqa: E402
from logmetrics.streaming import stateful as ST  # noqa: E402

AVAILABLE_NOW = {"availableNow": True}


SLICES = 3


def replay_stream(spark, sf_dir, name, start, max_files=None, logs=None, offsets=False, weekly=False):
    """Replay the fixture's topic records in ``SLICES`` equal parts of their time, or
    ``weekly``, in as many parts as there are weeks with records.

    Each slice's records are added to the topic folder after the one before has been
    processed, and ``start(stream, root)`` is run again from its checkpoint, so batches
    follow the slices whatever order a file store lists files in.  ``logs`` may carry a
    ``slice`` of their own, and with ``offsets`` their place in the topic.  Returns the
    scratch folder."""
    root = scratch_path(spark, name)
    if logs is None:
        logs = with_weeks(load_logs(spark, sf_dir)) if weekly else with_slices(load_logs(spark, sf_dir))
    wire = wire_records(logs, keep=["slice", *(["partition", "offset"] if offsets else [])])
    if weekly:  # a few files a week, not one from every task
        wire = wire.repartitionByRange("slice", "timestamp")
    wire.write.partitionBy("slice").parquet(f"{root}/staged")
    staged = spark.read.parquet(f"{root}/staged")
    slices = [r["slice"] for r in staged.select("slice").distinct().orderBy("slice").collect()] if weekly else range(SLICES)
    for k in slices:
        staged.filter(F.col("slice") == k).drop("slice").write.mode("append").parquet(f"{root}/wire")
        start(read_log_stream(spark, "parquet", f"{root}/wire", max_files_per_trigger=max_files, offsets=offsets), root).awaitTermination()
    return root


def with_slices(logs):
    """``slice``: which of ``SLICES`` equal parts of the logs' time an event falls in."""
    us = epoch_micros("event_ts")
    ends = logs.agg(F.min(us).alias("lo"), F.max(us).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    part = F.least(F.floor((us - lo) * SLICES / (hi - lo + 1)), F.lit(SLICES - 1))
    return logs.withColumn("slice", F.coalesce(part, F.lit(0)).cast("int"))


def with_weeks(logs):
    """``slice``: the week, from Monday, an event falls in; without a time, the first."""
    week = F.floor(F.datediff(F.to_date("event_ts"), F.lit("2000-01-03").cast("date")) / 7)
    first = logs.agg(F.min(week).alias("first")).scalar()
    return logs.withColumn("slice", F.coalesce(week, first, F.lit(0)).cast("int"))


@register("stream_batch_metrics")
def q_stream_batch_metrics(spark, sf_dir):
    """All gauges of every micro-batch, one a week, as the job's sink stored them."""
    root = metrics_job(spark, sf_dir, weekly=True)
    return J.read_history(spark, f"{root}/history").drop("date")


def metrics_job(spark, sf_dir, weekly=False):
    return replay_stream(spark, sf_dir, "stream-metrics", lambda s, root: J.start_metrics_job(s, f"{root}/history", f"{root}/ckpt", AVAILABLE_NOW), weekly=weekly)


@register("history_compacted")
def q_history_compacted(spark, sf_dir):
    """The whole history, from three commits that each hold some batches of every date,
    after compaction has made one folder per date of the older two."""
    history, root = fixture_history(spark, sf_dir, stored=True), scratch_path(spark, "history")
    for k in range(SLICES):
        entry = V.write_folder(history.where(F.col("batch_id") % SLICES == k), root, J.TABLE, "ts")
        V.commit(spark, root, lambda _, entry=entry: ([entry], []), "replay", k)
    J.compact_history(spark, root)
    return J.read_history(spark, root).drop("date")


@register("history_snapshot")
def q_history_snapshot(spark, sf_dir):
    """The newest batch, read by the folder of the last commit alone."""
    return J.latest_snapshot(spark, f"{metrics_job(spark, sf_dir)}/history")


@register("rate_limited_stream")
def q_rate_limited_stream(spark, sf_dir):
    """One file per trigger: more, smaller batches, and the same records in all."""
    root = replay_stream(spark, sf_dir, "stream-limited", lambda s, root: J.start_metrics_job(s, f"{root}/history", f"{root}/ckpt", AVAILABLE_NOW), 1)
    h = S.select_series(J.read_history(spark, f"{root}/history"), metric=METRIC_LOGS_PER_BATCH)
    return h.groupBy("service", "level").agg(F.sum("value").cast("long").alias("log_count"))


@register("stream_logs_total")
def q_stream_logs_total(spark, sf_dir):
    def start(stream, root):
        return ST.start_changes_sink(ST.logs_total(parse_logs(stream, columns=["service", "level"])), f"{root}/total", f"{root}/ckpt", AVAILABLE_NOW)

    root = replay_stream(spark, sf_dir, "stream-total", start)
    schema = ST.logs_total(load_logs(spark, sf_dir)).schema
    return ST.read_changes(spark, f"{root}/total", schema)


@register("stream_window_1m")
def q_stream_window_1m(spark, sf_dir):
    def start(stream, root):
        parsed = parse_logs(stream, columns=["timestamp", "service", "level", "response_time_ms"])
        windows = ST.windowed_stream(parsed, "1 minute", "1 minute")
        return ST.start_append_sink(windows, f"{root}/windows", f"{root}/ckpt", trigger=AVAILABLE_NOW)

    root = replay_stream(spark, sf_dir, "stream-window", start)
    return spark.read.parquet(f"{root}/windows")


@register("archive_logs")
def q_archive_logs(spark, sf_dir):
    """The archive as the stream writes it, by event date."""
    def start(stream, root):
        return ST.start_append_sink(ST.archive_stream(parse_logs(stream)), f"{root}/archive", f"{root}/ckpt", partition_by=["date"], trigger=AVAILABLE_NOW)

    root = replay_stream(spark, sf_dir, "stream-archive", start)
    return A.scan_archive(spark, f"{root}/archive").select("date", "request_id", "service", "level", "response_time_ms")


@register("scan_archive")
def q_scan_archive(spark, sf_dir):
    """A fortnight of the archive, by partition filter."""
    root = scratch_path(spark, "archive")
    A.write_archive(load_logs(spark, sf_dir), root)
    return A.scan_archive(spark, root, "2024-01-08", "2024-01-21").select("event_id", "date", "service", "level", "http_status",
                                               "response_time_ms")


@register("retention_tables")
def q_retention_tables(spark, sf_dir):
    """Hot and archive tables after three advancing runs: 7 days hot, 20 days in all."""
    logs = load_logs(spark, sf_dir).select("event_id", "event_ts")
    root = scratch_path(spark, "lifecycle")
    LC.ingest(logs, root)
    newest = logs.agg(F.max("event_ts")).first()[0]
    for back in (15, 4, 0):
        LC.apply_retention(spark, root, logs.schema, newest - dt.timedelta(days=back), hot_days=7, archive_days=20)
    tables = [LC.scan(spark, root, t, logs.schema).select(F.lit(t).alias("tab"), "*") for t in (LC.HOT, LC.ARCHIVE)]
    return tables[0].unionByName(tables[1])


@register("ledger_balance")
def q_ledger_balance(spark, sf_dir):
    """What became of every record of a disordered stream: emitted, open, late, unreadable."""
    return LG.balance(spark, ledger_job(spark, sf_dir))


@register("ledger_windows")
def q_ledger_windows(spark, sf_dir):
    """The closed windows of the same stream."""
    return LG.emitted_windows(spark, ledger_job(spark, sf_dir))


def ledger_job(spark, sf_dir):
    """Some records arrive a slice after their time, some carry a time that can't be read."""
    logs = with_slices(load_logs(spark, sf_dir))
    e = F.col("event_id")
    logs = logs.withColumn("slice", F.when(e % 50 == 7, F.least(F.col("slice") + 1, F.lit(SLICES - 1))).otherwise(F.col("slice")))
    logs = logs.withColumn("timestamp", F.when(e % 89 == 0, F.lit("2024-13-01T00:00:00Z")).otherwise(F.col("timestamp")))
    start = lambda s, root: LG.start_ledger_job(s, f"{root}/ledger", f"{root}/ckpt", "1 minute", "1 minute", trigger=AVAILABLE_NOW)
    return replay_stream(spark, sf_dir, "stream-ledger", start, logs=logs) + "/ledger"


def panel_job(spark, sf_dir):
    """Steps and bases, a batch per slice, of which the panel queries read what they need."""
    start = lambda s, root: PN.start_panel_job(s, f"{root}/panels", f"{root}/ckpt", trigger=AVAILABLE_NOW)
    return replay_stream(spark, sf_dir, "stream-panels", start) + "/panels"


@register("panel_counter")
def q_panel_counter(spark, sf_dir):
    """The counter over the dashboard's range, from one base and the range's steps."""
    return PN.panel_samples(spark, panel_job(spark, sf_dir))


@register("panel_rate_by_service")
def q_panel_rate_by_service(spark, sf_dir):
    return rounded(PN.panel_rate_sums(spark, panel_job(spark, sf_dir), LONG_RANGE, by=["service"]), "value")


@register("panel_error_rate")
def q_panel_error_rate(spark, sf_dir):
    return rounded(PN.panel_rate_ratio(spark, panel_job(spark, sf_dir), LONG_RANGE), "value")


@register("offset_ledger")
def q_offset_ledger(spark, sf_dir):
    """Lost and repeated offsets of a topic with three partitions, one of which holds more
    than half of the records: some records are lost, some come again a slice later."""
    e = F.col("event_id")
    logs = with_slices(load_logs(spark, sf_dir))
    hot, turn = e % 5 < 3, F.floor(e / 5)
    logs = logs.withColumn("partition", F.when(hot, 0).otherwise(e % 5 - 2).cast("int")).withColumn("offset", F.when(hot, turn * 3 + e % 5).otherwise(turn))
    again = logs.where(e % 101 < 3).withColumn("slice", F.least(F.col("slice") + 1, F.lit(SLICES - 1)))
    logs = logs.where(e % 97 != 5).unionByName(again.where(e % 97 != 5))
    start = lambda s, root: OF.start_offset_ledger(s, f"{root}/offsets", f"{root}/ckpt", AVAILABLE_NOW)
    root = replay_stream(spark, sf_dir, "stream-offsets", start, logs=logs, offsets=True)
    return OF.faults(OF.read_ranges(spark, f"{root}/offsets"))


@register("retention_split")
def q_retention_split(spark, sf_dir):
    t = A.retention_tiers(load_logs(spark, sf_dir))
    return t.groupBy(F.to_date("event_ts").alias("date"), "tier").agg(F.count(F.lit(1)).alias("rows"))


@register("logs_total")
def q_logs_total(spark, sf_dir):
    """The labelled log counter over the whole input (batch form of the streaming state)."""
    return ST.logs_total(load_logs(spark, sf_dir))
