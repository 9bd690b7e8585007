"""Stream sources and sinks for log records: the topic, and file stand-ins with the same
columns (``value BINARY``, ``timestamp``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType, TimestampNTZType

from logmetrics.config import DEFAULT_TOPIC

WIRE_SCHEMA = StructType([StructField("value", BinaryType(), True), StructField("timestamp", TimestampNTZType(), True)])
#: A record's place in the topic, for the ledger of offsets.
PLACE_SCHEMA = StructType([*WIRE_SCHEMA.fields, StructField("partition", IntegerType(), True), StructField("offset", LongType(), True)])


def kafka_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC, starting_offsets: str = "latest",
                  fail_on_data_loss: bool = True, max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the topic source: start at the latest offsets on a first start (a
    checkpoint overrides it), fail when offsets expired before they were read, and admit
    whatever has arrived.  ``config.ORIGINAL_SOURCE`` holds the original job's choice, a
    cap per micro-batch and silent skipping; with it, a lag beyond the topic's retention
    loses records without an error."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def read_log_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                    options: dict[str, str] | None = None, max_files_per_trigger: int | None = None, offsets: bool = False) -> DataFrame:
    """Streaming DataFrame of topic records, with ``offsets`` also their ``partition`` and
    ``offset``.

    ``fmt='kafka'`` needs the Kafka connector on the classpath and ``options`` from
    ``kafka_options``.  File formats (``parquet``, ``json``) read folders of wire
    records (``value``, ``timestamp``); ``max_files_per_trigger`` is their admission
    control."""
    reader, schema = spark.readStream.format(fmt), PLACE_SCHEMA if offsets else WIRE_SCHEMA
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "kafka":
        return reader.load().select(*schema.names)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader.schema(schema).load(path)


def write_topic(records: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Send a batch of encoded records (``value``, optional ``key``) to the topic."""
    topic_writer(records.write, bootstrap_servers, topic).save()


def topic_writer(writer, bootstrap_servers: str, topic: str = DEFAULT_TOPIC, checkpoint: str | None = None):
    """``writer`` (``df.write`` or ``df.writeStream``) set up for the topic; a stream needs
    a checkpoint folder and is started by the caller."""
    writer = writer.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer
