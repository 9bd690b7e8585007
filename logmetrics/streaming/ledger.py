"""Event-time windows that account for every record.

A windowed stream drops late records, and records whose time can't be read, without a
trace.  This job keeps a ledger: per micro-batch, records are on time, late or unreadable;
late and unreadable ones go whole to a table of their own, with the reason, and the
windows' state is itself a table.  So at any version

    input = emitted + open + late + unreadable

The watermark is the newest event time of all earlier batches less the delay; a record is
late if its window ended by then, as in the built-in windows.  After a batch, windows that
ended by the new watermark are emitted; the others' counts and latency sketches are merged
into the next state.  All of a batch - emitted windows, state, late records, ledger row -
becomes visible in one commit with the batch's number (``sources.versions``), so a batch
that is retried after a crash counts once.

A batch is read once: it is persisted while its two outputs are written.  The state holds
open windows only, one row per window and labels, so it is bounded by the delay."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logmetrics.config import DEFAULT_TRIGGER, DEFAULT_WATERMARK
from logmetrics.functions.time import add_micros, bucket_start, interval_micros, ntz_literal, parse_iso_utc
from logmetrics.operators import sketches as K
from logmetrics.session import materialize
from logmetrics.sources import versions as V
from logmetrics.sources.codec import parse_logs

WINDOWS, OPEN, LATE, LEDGER = "windows", "open", "late", "ledger"
LEDGER_SCHEMA = "batch_id bigint, input bigint, on_time bigint, late bigint, unreadable bigint, watermark timestamp_ntz"
_MEASURES = "log_count bigint, error_count bigint, latency_sum bigint, latency_count bigint, latency binary"


def _state_schema(keys: Sequence[str]) -> str:
    return "window_start timestamp_ntz, " + "".join(f"{k} string, " for k in keys) + _MEASURES


def _window_schema(keys: Sequence[str]) -> str:
    return ("window_start timestamp_ntz, window_end timestamp_ntz, " + "".join(f"{k} string, " for k in keys)
            + "log_count bigint, error_count bigint, avg_latency double, p50 int, p95 int, p99 int")


def ledger_writer(root: str, duration: str, delay: str = DEFAULT_WATERMARK, keys: Sequence[str] = ("service", "level"), writer: str = "job") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over parsed logs."""
    keys, wide = list(keys), interval_micros(duration)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = V.newest(spark, root)
        if base.done(writer) >= batch_id:
            return
        state = base.of(OPEN)
        newest = state[-1].high if state else None
        mark = None if newest is None else newest - dt.timedelta(microseconds=interval_micros(delay))
        when = F.col("event_time")
        start = bucket_start("event_time", duration)
        is_late = F.lit(False) if mark is None else add_micros(start, wide) <= ntz_literal(mark)
        fate = F.when(when.isNull(), "unreadable").when(is_late, LATE).otherwise("on_time")
        rows = batch.withColumn("event_time", parse_iso_utc("timestamp")).withColumn("fate", fate).persist()
        try:
            counts = {r.fate: r for r in rows.groupBy("fate").agg(F.count("*").alias("n"), F.max("event_time").alias("newest")).collect()}
            n = {f: counts[f].n if f in counts else 0 for f in ("on_time", LATE, "unreadable")}
            if not sum(n.values()):
                return
            newest = max([t for t in (newest, *(r.newest for r in counts.values())) if t is not None], default=None)
            mark = None if newest is None else newest - dt.timedelta(microseconds=interval_micros(delay))
            fresh = rows.where("fate = 'on_time'").groupBy(start.alias("window_start"), *keys).agg(*K.sketch_measures())
            merged = V.read(spark, state, _state_schema(keys)).unionByName(fresh)
            merged = merged.groupBy("window_start", *keys).agg(*K.merged_measures())
            end = add_micros("window_start", wide)
            ended = F.lit(False) if mark is None else end <= ntz_literal(mark)
            merged = materialize(merged.withColumn("ended", ended), "ledger-merged")
            closed = K.sketch_percentiles(merged.where("ended").drop("ended")).withColumn("window_end", end)
            added = [
                V.write_folder(closed.select(*[c.strip().split()[0] for c in _window_schema(keys).split(",")]), root, WINDOWS, "window_start"),
                V.write_folder(rows.where("fate <> 'on_time'").withColumn("batch_id", F.lit(batch_id).cast("bigint")), root, LATE, "event_time"),
                V.write_folder(spark.createDataFrame([(batch_id, sum(n.values()), n["on_time"], n[LATE], n["unreadable"], mark)], LEDGER_SCHEMA), root, LEDGER, "watermark"),
            ]
            left = V.write_folder(merged.where(~F.col("ended")).drop("ended"), root, OPEN, "window_start")
            added = [e for e in added if e.rows] + [replace(left, high=newest)]
            V.commit(spark, root, lambda _: (added, state), writer, batch_id, base)
        finally:
            rows.unpersist()

    return write


def start_ledger_job(wire_stream: DataFrame, root: str, checkpoint: str, duration: str, delay: str = DEFAULT_WATERMARK,
                     keys: Sequence[str] = ("service", "level"), trigger: dict | None = None) -> StreamingQuery:
    """Start the job on topic records."""
    parsed = parse_logs(wire_stream, columns=["timestamp", "response_time_ms", *keys])
    return (
        parsed.writeStream.outputMode("append")
        .trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(ledger_writer(root, duration, delay, keys, checkpoint))
        .start()
    )


def emitted_windows(spark: SparkSession, root: str, keys: Sequence[str] = ("service", "level")) -> DataFrame:
    """All closed windows; each appears once."""
    return V.read(spark, V.newest(spark, root).of(WINDOWS), _window_schema(keys))


def late_records(spark: SparkSession, root: str, keys: Sequence[str] = ("service", "level")) -> DataFrame:
    """The records no window counts, with their ``fate`` and batch."""
    fields = {"timestamp": "string", "response_time_ms": "int", **{k: "string" for k in keys}, "kafka_timestamp": "timestamp_ntz", "event_time": "timestamp_ntz", "fate": "string", "batch_id": "bigint"}
    return V.read(spark, V.newest(spark, root).of(LATE), ", ".join(f"`{k}` {t}" for k, t in fields.items()))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch: records read, and what became of them."""
    return V.read(spark, V.newest(spark, root).of(LEDGER), LEDGER_SCHEMA)


def balance(spark: SparkSession, root: str, key: str = "service", keys: Sequence[str] = ("service", "level")) -> DataFrame:
    """(fate, key, rows) at the newest version: emitted, open, late and unreadable."""
    version = V.newest(spark, root)
    windows = V.read(spark, version.of(WINDOWS), _window_schema(keys)).select(F.lit("emitted").alias("fate"), key, "log_count")
    state = V.read(spark, version.of(OPEN), _state_schema(keys)).select(F.lit("open").alias("fate"), key, "log_count")
    lost = late_records(spark, root, keys).select("fate", key, F.lit(1).cast("bigint").alias("log_count"))
    return windows.unionByName(state).unionByName(lost).groupBy("fate", key).agg(F.sum("log_count").alias("rows"))
