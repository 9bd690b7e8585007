"""A ledger of the topic's offsets: which records were read, lost or read again.

A source that may skip expired offsets (``failOnDataLoss=false``) loses records without
an error, and a replay from an older position reads some twice.  This job records, per
micro-batch, the ranges of consecutive offsets it got from each partition of the topic,
in one commit with the batch's number (``sources.versions``), so a retried batch counts
once.  ``faults`` merges the ranges of all batches and returns the offsets between them
(lost) and under two of them (repeated).

Within a batch, ranges are found in blocks of ``BLOCK`` offsets, so a partition with most
of the records is spread over tasks; ranges that meet at a block's edge are joined
afterwards, when there are few rows.  An offset that comes k times in one batch is in k
ranges.  What leaves a batch is a row per range, not per record.

Records without partition or offset are in no range.  A topic that is compacted, or
written in transactions, has offsets that hold no record; those are reported as lost,
too.  What was lost before the first range, or after the last one, can't be seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampType

from logmetrics.config import DEFAULT_TRIGGER
from logmetrics.functions.time import from_epoch_micros
from logmetrics.sources import versions as V

TABLE = "ranges"
SCHEMA = "batch_id bigint, partition int, first_offset bigint, last_offset bigint, arrived timestamp_ntz"
BLOCK = 1 << 16


def _runs(rows: DataFrame, keys: list[str], first: str, last: str, extra: list[Column]) -> DataFrame:
    """Merge the ranges of each group that overlap or meet."""
    w = Window.partitionBy(*keys).orderBy(first, last)
    before = F.max(last).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = rows.withColumn("_new", F.when(F.col(first) <= before + 1, 0).otherwise(1))
    numbered = opens.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_run").agg(F.min(first).alias("first_offset"), F.max(last).alias("last_offset"), *extra).drop("_run")


def offset_ranges(records: DataFrame, batch_id: int, block: int = BLOCK) -> DataFrame:
    """Ranges of consecutive offsets of one micro-batch: ``SCHEMA``."""
    at = F.col("timestamp")
    if isinstance(records.schema["timestamp"].dataType, TimestampType):
        at = from_epoch_micros(F.unix_micros(at))
    placed = records.where("partition is not null and offset is not null").select("partition", "offset", at.alias("arrived"), F.floor(F.col("offset") / block).alias("_block"))
    # The k-th copies of an offset make ranges of their own.
    copies = Window.partitionBy("partition", "_block", "offset").orderBy("arrived")
    placed = placed.withColumn("_copy", F.row_number().over(copies))
    # Within (partition, block, copy) offsets are distinct, so consecutive ones keep their distance to their rank.
    rank = F.row_number().over(Window.partitionBy("partition", "_block", "_copy").orderBy("offset"))
    pieces = placed.withColumn("_island", F.col("offset") - rank).groupBy("partition", "_copy", "_block", "_island")
    pieces = pieces.agg(F.min("offset").alias("_first"), F.max("offset").alias("_last"), F.max("arrived").alias("arrived"))
    merged = _runs(pieces, ["partition", "_copy"], "_first", "_last", [F.max("arrived").alias("arrived")])
    return merged.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "partition", "first_offset", "last_offset", "arrived")


def range_writer(root: str, writer: str = "job", block: int = BLOCK) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over records with their place in the topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = V.newest(spark, root)
        if base.done(writer) >= batch_id:
            return
        entry = V.write_folder(offset_ranges(batch, batch_id, block), root, TABLE, "arrived")
        if entry.rows:
            V.commit(spark, root, lambda _: ([entry], []), writer, batch_id, base)

    return write


def start_offset_ledger(wire_stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the job on ``read_log_stream(..., offsets=True)``."""
    return (
        wire_stream.select("partition", "offset", "timestamp")
        .writeStream.outputMode("append")
        .trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(range_writer(root, checkpoint))
        .start()
    )


def read_ranges(spark: SparkSession, root: str) -> DataFrame:
    """The ranges of all batches."""
    return V.read(spark, V.newest(spark, root).of(TABLE), SCHEMA)


def faults(ranges: DataFrame) -> DataFrame:
    """(partition, fault, first_offset, last_offset): the offsets that no range holds,
    ``lost``, and those that two or more hold, ``repeated``, each as longest ranges."""
    w = Window.partitionBy("partition").orderBy("first_offset", "last_offset").rowsBetween(Window.unboundedPreceding, -1)
    seen = ranges.withColumn("_upto", F.max("last_offset").over(w)).where("_upto is not null")
    lost = seen.where("first_offset > _upto + 1").select("partition", F.lit("lost").alias("fault"), (F.col("_upto") + 1).alias("first_offset"), (F.col("first_offset") - 1).alias("last_offset"))
    # A range that begins at or below what was seen lies, so far, wholly under the range that reached furthest.
    twice = seen.where("first_offset <= _upto").select("partition", F.col("first_offset").alias("_first"), F.least("last_offset", "_upto").alias("_last"))
    repeated = _runs(twice, ["partition"], "_first", "_last", []).select("partition", F.lit("repeated").alias("fault"), "first_offset", "last_offset")
    return lost.unionByName(repeated)
