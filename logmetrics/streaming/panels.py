"""Panels that are refreshed every few seconds, without a scan of the history.

Each micro-batch adds its step counts to a table of versions (``sources.versions``), and
three things become visible in one commit:

* ``steps``: the batch's (labels, step, n), one folder per date.  A step that several
  batches reach has several rows, which readers add up, so late logs need no rewrite.
* ``bases``: per date that has steps, the number of each series' logs before that date.
  A date that opens takes over the base and the steps of the date before it; late logs add
  rows to the bases of all later dates.
* ``series``: each series' first step and its count, which range functions need where a
  range begins before a series does.  One row per series, replaced by every commit.

A panel reads the step folders that reach into its range (a range function's: its range
and one more), and for a counter's value the one base before it: by the manifest's dates,
so neither time nor files grow with the history.  What it returns equals the evaluation
over all logs: ``counters.counter_samples``, ``rate_sums`` and ``rate_ratio`` with the
same start and end.

Logs whose time can't be read are in no step (``streaming.ledger`` keeps account of them).
Before the first commit a panel is empty."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logmetrics.config import DASHBOARD_RANGE, DEFAULT_TRIGGER, SCRAPE_INTERVAL
from logmetrics.functions.time import interval_micros, ntz_literal, parse_iso_utc
from logmetrics.operators import counters as C
from logmetrics.session import materialize
from logmetrics.sources import versions as V
from logmetrics.sources.codec import parse_logs

STEPS, BASES, SERIES = "steps", "bases", "series"
KEYS = ("service", "level")
#: The job merges the folders of a date whenever this many batches have come.
COMPACT_EVERY = 200


def _schema(keys: Sequence[str]) -> str:
    return "".join(f"{k} string, " for k in keys) + "ts timestamp_ntz, n bigint"


def _summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "ts").agg(F.sum("n").alias("n"))


def _dates(version: V.Version) -> list[dt.date]:
    return sorted({e.date for e in version.of(STEPS)})


def _of_dates(spark: SparkSession, version: V.Version, tab: str, dates, keys: Sequence[str]) -> DataFrame:
    return V.read(spark, [e for e in version.of(tab) if e.date in dates], _schema(keys))


def _added_bases(spark: SparkSession, version: V.Version, delta: DataFrame, days: list[dt.date], keys: Sequence[str]) -> DataFrame:
    """Rows to add to ``bases`` for step counts ``delta`` of the dates ``days``."""
    known = _dates(version)
    out = spark.createDataFrame([], _schema(keys))
    later = [d for d in sorted({*known, *days}) if d > days[0]]
    if later:
        # Each series' new logs before each later date: a running sum over its few dates.
        totals = delta.select(*keys, F.to_date("ts").alias("day"), "n")
        opens = delta.select(*keys).distinct().select(*keys, F.explode(F.array(*map(F.lit, later))).alias("day"), F.lit(0).cast("bigint").alias("n"))
        before = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
        sums = totals.unionByName(opens).groupBy(*keys, "day").agg(F.sum("n").alias("n")).select(*keys, "day", F.sum("n").over(before).alias("n"))
        out = out.unionByName(sums.where("n > 0").select(*keys, F.col("day").cast("timestamp_ntz").alias("ts"), "n"))
    heirs: dict[dt.date, list[dt.date]] = {}
    for day in sorted(set(days) - set(known)):
        if earlier := [d for d in known if d < day]:
            heirs.setdefault(earlier[-1], []).append(day)
    if heirs:
        to = F.create_map(*[c for d, opened in heirs.items() for c in (F.lit(d), F.array(*map(F.lit, opened)))])
        held = _of_dates(spark, version, BASES, heirs, keys).unionByName(_of_dates(spark, version, STEPS, heirs, keys))
        held = held.groupBy(*keys, F.to_date("ts").alias("day")).agg(F.sum("n").alias("n"))
        held = held.select(*keys, F.explode(to[F.col("day")]).alias("ts"), "n")
        out = out.unionByName(held.withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    return _summed(out, keys)


def _first_steps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min_by("n", "ts").alias("n"), F.min("ts").alias("ts")).select(*keys, "ts", "n")


def panel_writer(root: str, step: str = SCRAPE_INTERVAL, keys: Sequence[str] = KEYS, writer: str = "job",
                 time_col: str = "event_time", compact_every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over logs with their event time.  A batch is read once; a
    batch that comes again adds nothing.  If another writer commits first, what the batch
    adds is worked out again from that version."""
    keys = list(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = V.newest(spark, root)
        if base.done(writer) >= batch_id:
            return
        delta = materialize(C.step_counts(batch, step, keys, time_col), "panel-steps")
        days = sorted(r.day for r in delta.select(F.to_date("ts").alias("day")).distinct().collect())  # a row per date
        if not days:
            return
        steps = V.write_dates(delta, root, STEPS, "ts")

        def change(version: V.Version) -> V.Change:
            bases = V.write_dates(_added_bases(spark, version, delta, days, keys), root, BASES, "ts")
            old = version.of(SERIES)
            firsts = V.read(spark, old, _schema(keys)).unionByName(_first_steps(delta, keys))
            series = V.write_folder(_first_steps(_summed(firsts, keys), keys).coalesce(1), root, SERIES, "ts")
            return [*steps, *bases, series], old

        V.commit(spark, root, change, writer, batch_id, base)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_panels(spark, root, keys)

    return write


def compact_panels(spark: SparkSession, root: str, keys: Sequence[str] = KEYS) -> V.Version:
    """Dates of several folders become one folder each, with one row per (labels, ts)."""

    def merge(version: V.Version) -> V.Change | None:
        add, remove = [], []
        for tab in (STEPS, BASES):
            entries = version.of(tab)
            several = {e.date for e in entries if sum(o.date == e.date for o in entries) > 1}
            if several:
                remove += [e for e in entries if e.date in several]
                add += V.write_dates(_summed(_of_dates(spark, version, tab, several, keys), keys), root, tab, "ts")
        return (add, remove) if remove else None

    return V.commit(spark, root, merge)


def start_panel_job(wire_stream: DataFrame, root: str, checkpoint: str, step: str = SCRAPE_INTERVAL, keys: Sequence[str] = KEYS,
                    trigger: dict | None = None) -> StreamingQuery:
    """Start the job on topic records."""
    parsed = parse_logs(wire_stream, columns=["timestamp", *keys]).withColumn("event_time", parse_iso_utc("timestamp"))
    return (
        parsed.writeStream.outputMode("append")
        .trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(panel_writer(root, step, keys, checkpoint))
        .start()
    )


def panel_range(version: V.Version, range_: str = DASHBOARD_RANGE, end: dt.datetime | None = None) -> tuple[dt.datetime, dt.datetime] | None:
    """Start and end of a panel: by default it ends at the newest step there is."""
    if end is None:
        end = max((e.high for e in version.of(STEPS)), default=None)
    return None if end is None else (end - dt.timedelta(microseconds=interval_micros(range_)), end)


def step_folders(version: V.Version, after: dt.datetime, end: dt.datetime) -> list[V.Entry]:
    """The folders with steps in (after, end]."""
    return [e for e in version.of(STEPS) if e.high > after and e.low <= end]


def _steps(spark: SparkSession, version: V.Version, after: dt.datetime, end: dt.datetime, keys: Sequence[str]) -> DataFrame:
    rows = V.read(spark, step_folders(version, after, end), _schema(keys))
    return _summed(rows.where((F.col("ts") > ntz_literal(after)) & (F.col("ts") <= ntz_literal(end))), keys)


def base_at(spark: SparkSession, version: V.Version, at: dt.datetime, keys: Sequence[str] = KEYS) -> DataFrame:
    """(labels, ts = ``at``, n = logs up to it) from one date's base and steps."""
    date = [d for d in _dates(version) if d <= at.date()][-1:]
    rows = _of_dates(spark, version, BASES, date, keys).unionByName(_of_dates(spark, version, STEPS, date, keys).where(F.col("ts") <= ntz_literal(at)))
    return rows.groupBy(*keys).agg(F.sum("n").alias("n")).select(*keys, ntz_literal(at).alias("ts"), "n")


def panel_samples(spark: SparkSession, root: str, range_: str = DASHBOARD_RANGE, step: str = SCRAPE_INTERVAL, keys: Sequence[str] = KEYS,
                  end: dt.datetime | None = None) -> DataFrame:
    """The counter at every step of the panel: (labels, ts, value)."""
    version = V.newest(spark, root)
    span = panel_range(version, range_, end)
    if span is None:
        return spark.createDataFrame([], "".join(f"{k} string, " for k in keys) + "ts timestamp_ntz, value double")
    start, end = span
    counts = base_at(spark, version, start, keys).unionByName(_steps(spark, version, start, end, keys))
    return C.cumulative_samples(counts, keys, step, start=start, end=end)


def _rate_counts(spark: SparkSession, version: V.Version, start: dt.datetime, end: dt.datetime, range_: str, keys: Sequence[str]) -> DataFrame:
    """Step counts that the ranges of a panel need: its steps, and the first step of each
    series that began before them."""
    after = start - dt.timedelta(microseconds=interval_micros(range_))
    firsts = V.read(spark, version.of(SERIES), _schema(keys)).where(F.col("ts") <= ntz_literal(after))
    return firsts.unionByName(_steps(spark, version, after, end, keys))


def panel_rate_sums(spark: SparkSession, root: str, rate_range: str, range_: str = DASHBOARD_RANGE, step: str = SCRAPE_INTERVAL, by: Sequence[str] = (),
                    keys: Sequence[str] = KEYS, end: dt.datetime | None = None) -> DataFrame:
    """``sum by (by) (rate(logs_produced_total[rate_range]))`` at every step of the panel."""
    version = V.newest(spark, root)
    span = panel_range(version, range_, end)
    if span is None:
        return spark.createDataFrame([], "ts timestamp_ntz, " + "".join(f"{k} string, " for k in by) + "value double")
    return C.counts_rate_sums(_rate_counts(spark, version, *span, rate_range, keys), rate_range, step, by, keys, start=span[0], end=span[1])


def panel_rate_ratio(spark: SparkSession, root: str, rate_range: str, range_: str = DASHBOARD_RANGE, step: str = SCRAPE_INTERVAL,
                     keys: Sequence[str] = KEYS, end: dt.datetime | None = None) -> DataFrame:
    """Share of errors in the summed rates, in percent, at every step of the panel."""
    version = V.newest(spark, root)
    span = panel_range(version, range_, end)
    if span is None:
        return spark.createDataFrame([], "ts timestamp_ntz, value double")
    return C.counts_rate_ratio(_rate_counts(spark, version, *span, rate_range, keys), rate_range, step, keys=keys, start=span[0], end=span[1])
