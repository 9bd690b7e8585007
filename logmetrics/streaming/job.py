"""The streaming metrics job: topic records -> parse -> per micro-batch gauges -> metrics
history, a table of versions (``sources.versions``), and from it the latest snapshot.

A batch is read once, by one aggregation over raw records that also finds its newest
arrival, which is the batch's time.  Its gauges become one folder, and a commit names it
together with the batch's number: a batch that is retried, before or after its commit,
adds nothing twice, and an empty one commits nothing, so the previous snapshot stays.
Write errors are not swallowed: the batch fails and is retried from the checkpoint.

Compaction is a commit as well.  Readers see the folders of one version, so they get the
same rows before, during and after it, and a late batch of a compacted date is simply a
further folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampType

from logmetrics.config import DEFAULT_QUERY_NAME, DEFAULT_TRIGGER
from logmetrics.functions.time import from_epoch_micros, ntz_literal
from logmetrics.operators.metrics import metric_samples
from logmetrics.sources import versions as V
from logmetrics.sources.codec import parse_logs

JOB_FIELDS = ["service", "level", "response_time_ms"]
HISTORY = "batch_id bigint, ts timestamp_ntz, metric string, service string, level string, percentile string, value double"
TABLE = "history"
#: The job merges folders whenever this many have come together.
COMPACT_AT = 500


def batch_samples(batch_df: DataFrame, batch_id: int) -> DataFrame:
    """History rows of one micro-batch: (batch_id, ts, metric, service, level, percentile,
    value); ``ts`` is the batch's newest arrival time (UTC wall clock)."""
    newest = F.col("kafka_timestamp")
    if isinstance(batch_df.schema["kafka_timestamp"].dataType, TimestampType):
        newest = from_epoch_micros(F.unix_micros(newest))
    rows = metric_samples(batch_df, stamp="kafka_timestamp")
    return rows.select(F.lit(int(batch_id)).cast("long").alias("batch_id"), newest.alias("ts"), "metric", "service", "level", "percentile", "value")


def create_history(spark: SparkSession, path: str) -> V.Version:
    """Make the (empty) history, so that it can be read before the first batch."""
    return V.commit(spark, path, lambda v: None if v.number else ((), ()))


def history_writer(path: str, writer: str = "job", compact_at: int = COMPACT_AT) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds one batch's gauges to the history.  ``writer``
    names the stream whose batch numbers these are: its checkpoint."""
    seen: list[V.Version] = []  # the version after this writer's last commit

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        base = seen.pop() if seen else V.newest(spark, path)
        if base.done(writer) >= batch_id:
            return
        entry = V.write_folder(batch_samples(batch_df, batch_id), path, TABLE, "ts")
        if entry.rows:
            base = V.commit(spark, path, lambda _: ([entry], []), writer, batch_id, base)
        if len(base.of(TABLE)) % compact_at == 0 and entry.rows:
            base = compact_history(spark, path)
        seen.append(base)

    return write


def compact_history(spark: SparkSession, path: str) -> V.Version:
    """Merge all batches but the newest to one folder per date, by one parallel write."""
    return V.compact(spark, path, TABLE, HISTORY, "ts", spare=1)


def read_history(spark: SparkSession, path: str, version: int | None = None, start: dt.datetime | None = None, stop: dt.datetime | None = None) -> DataFrame:
    """The history with its ``date``, in one version.  A time range (both ends included)
    reads the folders that reach into it, and no others."""
    entries = V.newest(spark, path, version).of(TABLE)
    if start is not None:
        entries = [e for e in entries if e.high is not None and e.high >= start]
    if stop is not None:
        entries = [e for e in entries if e.low is not None and e.low <= stop]
    rows = V.read(spark, entries, HISTORY)
    if start is not None:
        rows = rows.where(F.col("ts") >= ntz_literal(start))
    if stop is not None:
        rows = rows.where(F.col("ts") <= ntz_literal(stop))
    return rows.withColumn("date", F.to_date("ts"))


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest batch's gauges: the folder of the last commit, and no other, is read."""
    return V.read(spark, V.newest(spark, path).of(TABLE)[-1:], HISTORY)


def start_metrics_job(wire_stream: DataFrame, history_path: str, checkpoint: str,
                      trigger: dict | None = None, query_name: str = DEFAULT_QUERY_NAME) -> StreamingQuery:
    """Start the job.  ``trigger`` is passed to ``DataStreamWriter.trigger`` (default:
    processing time every second; tests use ``{"availableNow": True}``)."""
    create_history(wire_stream.sparkSession, history_path)
    parsed = parse_logs(wire_stream, columns=JOB_FIELDS)
    return (
        parsed.writeStream.outputMode("append")
        .trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
        .option("checkpointLocation", checkpoint)
        .queryName(query_name)
        .foreachBatch(history_writer(history_path, checkpoint))
        .start()
    )
