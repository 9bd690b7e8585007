"""Retention of raw logs as a job: hot and archive tables that change together.

Both tables are folders per event date under one list of versions (``versions``).  A run
at ``as_of`` moves what is older than the hot days to the archive and drops what is older
than the archive's days.  Dates wholly on one side move as they are; the date that the
boundary cuts is rewritten in both tables.  All moves become visible in one commit, so a
row is in one table in every version, and a run that dies or is repeated changes nothing.

Ages are intervals to the microsecond, as in ``retention_tiers``.  Rows without an event
time have no age and stay hot.  A late row enters the hot table and moves with the next
run.  ``as_of`` may only advance: an earlier one moves nothing back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logmetrics.functions.time import ntz_literal
from logmetrics.sources import versions as V
from logmetrics.sources.archive import HOT_DAYS

HOT, ARCHIVE = "hot", "archive"


def ingest(logs: DataFrame, root: str, writer: str = "ingest", work: int = 0, time_col: str = "event_ts") -> V.Version:
    """Add logs to the hot table.  ``work`` numbers a writer's batches (a streaming batch's
    id); a batch that is repeated adds nothing."""
    spark = logs.sparkSession
    if V.newest(spark, root).done(writer) >= work:
        return V.newest(spark, root)
    made = V.write_dates(logs, root, HOT, time_col)
    return V.commit(spark, root, lambda _: (made, []), writer, work)


def apply_retention(spark: SparkSession, root: str, schema: StructType | str, as_of: dt.datetime, hot_days: int = HOT_DAYS,
                    archive_days: int | None = None, time_col: str = "event_ts") -> V.Version:
    """One run: the moves of all dates, in one commit."""
    edge = as_of - dt.timedelta(days=hot_days)
    end = None if archive_days is None else as_of - dt.timedelta(days=archive_days)
    at = F.col(time_col)

    def moves(base: V.Version):
        hot, old = base.of(HOT), base.of(ARCHIVE)
        aged = [e for e in hot if e.low is not None and e.low < edge]
        expired = [e for e in old if end is not None and e.low is not None and e.low < end]
        if not aged and not expired:
            return None
        cut = [e for e in aged if e.high >= edge]
        shorter = [e for e in expired if e.high >= end]
        to_archive = V.read(spark, aged, schema).where(at < ntz_literal(edge))
        if end is not None:
            to_archive = to_archive.where(at >= ntz_literal(end))
        made = V.write_dates(to_archive, root, ARCHIVE, time_col) if aged else []
        if cut:
            made += V.write_dates(V.read(spark, cut, schema).where(at >= ntz_literal(edge)), root, HOT, time_col)
        if shorter:
            made += V.write_dates(V.read(spark, shorter, schema).where(at >= ntz_literal(end)), root, ARCHIVE, time_col)
        return made, [*aged, *expired]

    return V.commit(spark, root, moves)


def scan(spark: SparkSession, root: str, table: str, schema: StructType | str, start: dt.date | None = None, stop: dt.date | None = None,
         version: int | None = None) -> DataFrame:
    """Rows of one table in one version; only the folders of the dates asked for (both
    included) are read."""
    entries = V.newest(spark, root, version).of(table)
    if start is not None:
        entries = [e for e in entries if e.date is not None and e.date >= start]
    if stop is not None:
        entries = [e for e in entries if e.date is not None and e.date <= stop]
    return V.read(spark, entries, schema)


def compact(spark: SparkSession, root: str, table: str, schema: StructType | str, time_col: str = "event_ts") -> V.Version:
    """Dates of several folders, as late rows make them, become one folder each."""
    return V.compact(spark, root, table, schema, time_col)
