"""Stateful streaming operators: the labelled log counter kept in state, event-time
windows bounded by a watermark, and the raw-log archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from logmetrics.config import DEFAULT_ACCURACY, DEFAULT_WATERMARK
from logmetrics.functions.time import from_epoch_micros, parse_instant
from logmetrics.operators.metrics import log_measures


def with_event_instant(parsed: DataFrame, out: str = "event_time") -> DataFrame:
    """Event time as TIMESTAMP (what ``withWatermark`` needs); null when unparseable."""
    return parsed.withColumn(out, parse_instant("timestamp"))


def logs_total(parsed: DataFrame, keys: Sequence[str] = ("service", "level")) -> DataFrame:
    """``logs_produced_total{labels}`` as streaming state: a running count per label set
    (``update`` or ``complete`` output mode)."""
    return parsed.groupBy(*keys).agg(F.count(F.lit(1)).alias("logs_total"))


def start_changes_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep a stateful query's changed rows (``update`` mode), one partition per batch: a
    trigger writes what it changed, never the whole state, and never a table that is
    being read; a retried batch rewrites its own partition."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        (
            batch_df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    schema = StructType([*df.schema.fields, StructField("batch_id", LongType())])
    df.sparkSession.createDataFrame([], schema).write.mode("append").partitionBy("batch_id").parquet(path)
    return (
        df.writeStream.outputMode("update")
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )


def read_changes(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = ("service", "level")) -> DataFrame:
    """The newest row per key of a changes table."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(path)
    values = [c for c in schema.names if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max_by(v, "batch_id").alias(v) for v in values])


def windowed_stream(parsed: DataFrame, duration: str, watermark: str = DEFAULT_WATERMARK,
                    keys: Sequence[str] = ("service", "level"), accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    """Tumbling event-time windows with a watermark; in ``append`` mode a window is
    emitted once the watermark passes its end, and its state is dropped."""
    ev = with_event_instant(parsed).withWatermark("event_time", watermark)
    agg = ev.groupBy(F.window("event_time", duration).alias("window"), *keys).agg(*log_measures(accuracy, exact))
    return agg.select(
        from_epoch_micros(F.unix_micros(F.col("window.start"))).alias("window_start"),
        from_epoch_micros(F.unix_micros(F.col("window.end"))).alias("window_end"),
        *keys, "log_count", "avg_latency", "p50", "p95", "p99", "error_count",
    )


def start_append_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                      partition_by: Sequence[str] = (), trigger: dict | None = None) -> StreamingQuery:
    w = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start(path)


def archive_stream(parsed: DataFrame) -> DataFrame:
    """Raw logs for the archive, with the ``date`` partition column (event date, UTC)."""
    return with_event_instant(parsed, "_et").withColumn(
        "date", F.to_date(from_epoch_micros(F.unix_micros(F.col("_et"))))
    ).drop("_et")
