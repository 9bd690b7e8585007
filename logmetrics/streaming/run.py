"""Run the metrics job on a topic:

    spark-submit --packages <kafka connector> -m logmetrics.streaming.run \\
        --bootstrap-servers host:9092 --history <folder> --checkpoint <folder>

Every argument can also come from the environment (in capitals, as in
``BOOTSTRAP_SERVERS``)."""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from logmetrics.config import DEFAULT_QUERY_NAME, DEFAULT_TOPIC, DEFAULT_TRIGGER
from logmetrics.sources.streams import kafka_options, read_log_stream
from logmetrics.streaming.job import start_metrics_job


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    env = os.environ.get
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--bootstrap-servers", default=env("BOOTSTRAP_SERVERS"), required="BOOTSTRAP_SERVERS" not in os.environ)
    p.add_argument("--topic", default=env("TOPIC", DEFAULT_TOPIC))
    p.add_argument("--starting-offsets", default=env("STARTING_OFFSETS", "latest"))
    p.add_argument("--max-offsets-per-trigger", type=int, default=int(env("MAX_OFFSETS_PER_TRIGGER", "0")) or None)
    p.add_argument("--skip-lost-offsets", action="store_true", default=env("SKIP_LOST_OFFSETS", "") == "true")
    p.add_argument("--trigger", default=env("TRIGGER", DEFAULT_TRIGGER))
    p.add_argument("--history", default=env("HISTORY"), required="HISTORY" not in os.environ)
    p.add_argument("--checkpoint", default=env("CHECKPOINT"), required="CHECKPOINT" not in os.environ)
    p.add_argument("--query-name", default=env("QUERY_NAME", DEFAULT_QUERY_NAME))
    return p.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    a = arguments(argv)
    spark = SparkSession.builder.appName(a.query_name).getOrCreate()
    options = kafka_options(a.bootstrap_servers, a.topic, a.starting_offsets, not a.skip_lost_offsets, a.max_offsets_per_trigger)
    stream = read_log_stream(spark, "kafka", options=options)
    start_metrics_job(stream, a.history, a.checkpoint, {"processingTime": a.trigger}, a.query_name).awaitTermination()


if __name__ == "__main__":
    main()
