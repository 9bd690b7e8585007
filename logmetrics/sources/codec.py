"""Wire codec: log rows <-> topic records (``value BINARY``, ``timestamp``).

``parse_logs`` is the streaming job's decoder: ``CAST(value AS STRING)`` then
``from_json`` with the fixed 13-field schema in PERMISSIVE mode, so bad input becomes
null fields and the row is still counted.  ``encode_logs`` is the producer's encoder
as a column expression (``to_json(struct(...))``), so encoding runs in the JVM and
scales with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logmetrics.config import LOG_COLUMNS, LOG_SCHEMA
from logmetrics.functions.time import bucket_end


def log_schema(columns: Sequence[str] | None = None) -> StructType:
    """The log schema, or a narrower one with only ``columns``.

    Catalyst does not prune fields inside ``from_json``; a caller that needs three
    fields parses three fields instead of thirteen."""
    if columns is None:
        return LOG_SCHEMA
    wanted = set(columns)
    unknown = wanted - set(LOG_COLUMNS)
    if unknown:
        raise ValueError(f"not log fields: {sorted(unknown)}")
    return StructType([f for f in LOG_SCHEMA.fields if f.name in wanted])


def parse_logs(wire: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Decode topic records into log rows plus ``kafka_timestamp``.

    ``columns`` narrows the parsed fields; ``keep`` passes other wire columns through."""
    schema = log_schema(columns)
    passthrough = [F.col(c) for c in keep]
    return (
        wire.select(
            F.col("value").cast("string").alias("json_str"),
            F.col("timestamp").alias("kafka_timestamp"),
            *passthrough,
        )
        .select(F.from_json(F.col("json_str"), schema).alias("log"), "kafka_timestamp", *keep)
        .select("log.*", "kafka_timestamp", *keep)
    )


def encode_logs(logs: DataFrame, columns: Sequence[str] = LOG_COLUMNS, timestamp_col: str = "timestamp_wire",
                keep: Sequence[str] = ()) -> DataFrame:
    """Encode log rows as topic records: ``value`` = UTF-8 JSON of the log fields (null
    fields omitted), ``timestamp`` = the record time.  No key: the producer sends
    unkeyed records, so no topic partition is bound to a hot service."""
    value = F.to_json(F.struct(*[F.col(c) for c in columns])).cast("binary")
    return logs.select(value.alias("value"), F.col(timestamp_col).alias("timestamp"), *keep)


def wire_records(logs: DataFrame, flush_interval: str = "1 second", keep: Sequence[str] = ()) -> DataFrame:
    """Topic records for the fixture logs.  The producer flushes its batch once per
    ``flush_interval``, so a record's topic timestamp is the end of the flush interval
    its event falls in."""
    with_ts = logs.withColumn("timestamp_wire", bucket_end("event_ts", flush_interval))
    return encode_logs(with_ts, keep=keep)
