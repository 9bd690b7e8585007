"""The raw-log archive: date-partitioned parquet, scans with partition pruning, and the
retention split (topic / hot / archive tiers by age)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmetrics.functions.time import add_micros, interval_micros, ntz_literal

TOPIC_DAYS = 7
HOT_DAYS = 30


def write_archive(logs: DataFrame, path: str, time_col: str = "event_ts") -> None:
    """Write logs to the archive, one folder per event date; a date that is written again
    is replaced, so a repeated run doesn't double it.  Rows are range-partitioned
    on event time first: each task holds a contiguous time slice, so it writes files
    for one or two dates only, and a date holding a third of all rows is split over
    many tasks by the sampled range bounds instead of landing in one."""
    (
        logs.withColumn("date", F.to_date(F.col(time_col)))
        .repartitionByRange(F.col(time_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def scan_archive(spark: SparkSession, path: str, start: dt.date | str | None = None,
                 end: dt.date | str | None = None) -> DataFrame:
    """Read the archive; a date range becomes a partition filter (folders outside it are
    never listed into the scan)."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df


def retention_tiers(logs: DataFrame, as_of=None, time_col: str = "event_ts", topic_days: int = TOPIC_DAYS,
                    hot_days: int = HOT_DAYS) -> DataFrame:
    """Tag each row with its storage tier by age at ``as_of`` (default: newest event):
    'topic' from ``as_of`` minus ``topic_days`` on, 'hot' from ``as_of`` minus ``hot_days``
    on, else 'archive'.  Ages are intervals, to the microsecond, not calendar days."""
    end = logs.agg(F.max(time_col)).scalar() if as_of is None else ntz_literal(as_of)

    def since(days: int) -> F.Column:
        return F.col(time_col) >= add_micros(end, -interval_micros(f"{days} days"))

    return logs.withColumn("tier", F.when(since(topic_days), "topic").when(since(hot_days), "hot").otherwise("archive"))


def split_retention(logs: DataFrame, hot_path: str, archive_path: str, as_of=None, time_col: str = "event_ts", hot_days: int = HOT_DAYS) -> None:
    """Two writes by age at ``as_of``: rows within ``hot_days`` to the hot table, older ones
    to the archive; both by date, and safe to repeat."""
    tiers = retention_tiers(logs, as_of, time_col, hot_days=hot_days)
    write_archive(tiers.filter(F.col("tier") != "archive").drop("tier"), hot_path, time_col)
    write_archive(tiers.filter(F.col("tier") == "archive").drop("tier"), archive_path, time_col)
