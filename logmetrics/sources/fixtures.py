"""The ``logs`` view derived from the driver's ``events`` table.

Each event becomes one application log record.  The mapping is a pure projection
(no shuffle), so it scales with the scan and keeps parquet column pruning: only the
``events`` columns a query needs are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmetrics.config import WEB_MESSAGE, WEB_METHODS, WEB_PATHS, WEB_SERVICES
from logmetrics.functions.text import zero_padded
from logmetrics.functions.time import iso_utc

# The fixture spreads events over the first four paths.
FIXTURE_PATHS = WEB_PATHS[:4]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def logs_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` rows to log records: ``event_id``, ``event_ts`` and the 13 log fields."""
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    et = F.col("event_type")
    level = F.when(et == "error", "ERROR").when(et == "signup", "WARN").when(et == "view", "DEBUG").otherwise("INFO")
    status = (
        F.when(et == "error", F.lit(500) + F.pmod(k, F.lit(4)))
        .when(et == "signup", F.lit(400) + F.pmod(k, F.lit(5)))
        .otherwise(F.lit(200) + F.pmod(k, F.lit(5)))
        .cast("int")
    )
    uid, eid = F.col("user_id"), F.col("event_id")
    return events.select(
        eid.alias("event_id"),
        F.col("ts").alias("event_ts"),
        iso_utc("ts").alias("timestamp"),
        level.alias("level"),
        _pick(WEB_SERVICES, F.pmod(uid, F.lit(6))).alias("service"),
        F.concat(F.lit("host-"), (F.pmod(uid, F.lit(10)) + 1).cast("string")).alias("host"),
        zero_padded("req-", eid).alias("request_id"),
        F.concat(F.lit("trace-"), (F.lit(100000) + F.pmod(eid * 7919, F.lit(900000))).cast("string")).alias("trace_id"),
        _pick(WEB_METHODS, F.pmod(eid, F.lit(5))).alias("http_method"),
        _pick(FIXTURE_PATHS, F.pmod(uid, F.lit(4))).alias("http_path"),
        status.alias("http_status"),
        F.floor(F.col("value")).cast("int").alias("response_time_ms"),
        F.concat(
            F.lit("10.0."), (F.pmod(uid, F.lit(255)) + 1).cast("string"), F.lit("."),
            (F.pmod(eid, F.lit(255)) + 1).cast("string"),
        ).alias("client_ip"),
        F.lit(WEB_MESSAGE).alias("message"),
        F.lit(None).cast("string").alias("stack_trace"),
    )


def load_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``logs`` view of ``{sf_dir}/events.parquet``."""
    return logs_from_events(read_table(spark, sf_dir, "events"))

