"""Counters and their range functions: the questions the dashboard asks of
``logs_produced_total`` answered over tables.

* ``step_counts``: logs per (labels, step) - one partial aggregate over the raw logs,
  so the only shuffle of raw data carries per-task partial counts.
* ``cumulative_samples`` / ``counter_samples``: the counter as a scrape sees it at every
  step from the series' first step, or the evaluation start, to the evaluation end (by
  default the last step of the data).  What lies before the start is one base count.
* ``counter_range`` -> ``counter_increase`` / ``counter_rate``: for every evaluation
  time t on a step grid, the samples with t - range <= ts <= t (both ends included),
  reset corrections, and the rate with edge extrapolation.  A series is cut into time
  blocks padded by one range, so one sliding frame per block holds all that t needs, a
  hot series is spread over all tasks, and a sample is copied only near a block's edge.
* ``change_points``: the same for counters made from logs, but only at the steps whose
  range holds a change, each log count being spread over the ranges it falls in; all
  other steps of a series have an increase of zero.  ``rate_sums`` and ``rate_ratio`` add
  those rates up per time and lay the dense step grid once per time, not once per series.
* ``sum_rates`` / ``ratio_of_rates``: ``sum by (...)`` and the error-rate ratio of any rates.

Series labels are non-null strings: a null label becomes '' (an empty label value is
the same as no label in the exposition model).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logmetrics.config import ERROR_LEVEL
from logmetrics.functions.time import add_micros, bucket_end, epoch_micros, from_epoch_micros, interval_micros, ntz_literal
from logmetrics.operators.blocks import BLOCK
from logmetrics.session import materialize


def label_cols(keys: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys]


def step_counts(logs: DataFrame, step: str, keys: Sequence[str] = ("service", "level"),
                time_col: str = "event_ts") -> DataFrame:
    """(labels, ts = end of the step, n = logs in the step)."""
    return (
        logs.filter(F.col(time_col).isNotNull())
        .groupBy(*label_cols(keys), bucket_end(time_col, step).alias("ts"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def grid_points(starts: DataFrame, keys: Sequence[str], end: Column, step: str,
                block: str = BLOCK) -> DataFrame:
    """Every step-aligned time from each series' ``start`` to ``end`` (inclusive).

    Generated in two levels - first one row per (series, block), spread over tasks by a
    small repartition, then the step times inside each block - so a long grid is not
    generated by one task."""
    keys = list(keys)
    s_us, b_us = interval_micros(step), interval_micros(block)
    b_us = max(s_us, b_us - b_us % s_us)  # blocks hold whole steps
    start = epoch_micros("start")
    stop = epoch_micros(end)
    blocks = starts.select(
        *keys, start.alias("_s"), stop.alias("_e"),
    ).filter(F.col("_s") <= F.col("_e")).select(
        *keys, "_s", "_e",
        F.explode(F.sequence(F.col("_s") - F.pmod(F.col("_s"), F.lit(b_us)), F.col("_e"), F.lit(b_us))).alias("_b"),
    )
    lo = F.greatest(F.col("_b"), F.col("_s"))
    hi = F.least(F.col("_b") + F.lit(b_us - s_us), F.col("_e"))
    return (
        blocks.repartition(*keys, "_b")
        .select(*keys, F.explode(F.sequence(lo, hi, F.lit(s_us))).alias("_us"))
        .select(*keys, from_epoch_micros(F.col("_us")).alias("ts"))
    )


def _clip(df: DataFrame, start, end, ts: str = "ts") -> DataFrame:
    """Rows up to ``end``; rows before ``start`` are moved to it, where they are the base
    that a running sum starts from."""
    if end is not None:
        df = df.filter(F.col(ts) <= ntz_literal(end))
    if start is not None:
        df = df.withColumn(ts, F.greatest(F.col(ts), ntz_literal(start)))
    return df


def _blocks_of(step: str, block: str):
    """Start of the block that holds a time; blocks hold whole steps."""
    s_us, b_us = interval_micros(step), interval_micros(block)
    b_us = max(s_us, b_us - b_us % s_us)
    return b_us, lambda us: us - F.pmod(us, F.lit(b_us))


def _padded_samples(counts: DataFrame, keys: Sequence[str], step: str, values: Sequence[str], outs: Sequence[str],
                    start, end, block: str, pad: int) -> DataFrame:
    """Cumulative series at every step, in time blocks that also hold the steps of the
    ``pad`` microseconds before them: (labels, _blk, _us, outs).

    Steps, counts and a base row per block meet in one window: the base holds the sum of
    all earlier blocks, less the counts that the block's pad brings again."""
    keys, values, outs = list(keys), list(values), list(outs)
    counts = materialize(counts.select(*keys, "ts", *values), "step-counts")
    counts = _clip(counts, start, end)
    last = counts.agg(F.max("ts")).scalar() if end is None else ntz_literal(end)
    starts = counts.groupBy(*keys).agg(F.min("ts").alias("start"))
    b_us, blk = _blocks_of(step, block)
    us = epoch_micros("ts")
    zeros = [F.lit(0).cast("long").alias(v) for v in values]

    def padded(df: DataFrame) -> DataFrame:
        own = F.sequence(blk(F.col("_us")), blk(F.col("_us") + F.lit(pad)), F.lit(b_us))
        return df.withColumn("_blk", F.explode(own))

    steps = padded(grid_points(starts, keys, last, step, block).select(*keys, us.alias("_us"), *zeros, F.lit(True).alias("_step")))
    data = padded(counts.select(*keys, us.alias("_us"), *values, F.lit(False).alias("_step")))
    base_us = F.col("_blk") - F.lit(pad + 1)
    again = data.filter(blk(F.col("_us")) != F.col("_blk")).select(*keys, base_us.alias("_us"), *[(-F.col(v)).alias(v) for v in values], "_step", "_blk")
    all_blocks = starts.select(*keys, F.explode(F.sequence(blk(epoch_micros("start")), blk(epoch_micros(last) + F.lit(pad)), F.lit(b_us))).alias("_blk"), *zeros)
    totals = all_blocks.unionByName(counts.select(*keys, blk(us).alias("_blk"), *values)).groupBy(*keys, "_blk").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*keys, base_us.alias("_us"), *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(v) for v in values], F.lit(False).alias("_step"), "_blk")
    rows = steps.unionByName(data).unionByName(again).unionByName(base)
    upto = Window.partitionBy(*keys, "_blk").orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(v).over(upto).cast("double").alias(o) for v, o in zip(values, outs, strict=True)]
    return rows.select(*keys, "_blk", "_us", "_step", *sums).filter("_step").drop("_step")


def cumulative_samples(counts: DataFrame, keys: Sequence[str], step: str, values: Sequence[str] = ("n",),
                       outs: Sequence[str] = ("value",), start=None, end=None, block: str = BLOCK) -> DataFrame:
    """Cumulative series at every step from per-step counts ``(labels, ts, values)``.

    ``start`` and ``end`` (step-aligned) bound the evaluation.  The counts (one row per
    series and active step, independent of log volume) are stored once, since end of
    data, series starts, block totals and values all come from them."""
    rows = _padded_samples(counts, keys, step, values, outs, start, end, block, 0)
    return rows.select(*keys, from_epoch_micros(F.col("_us")).alias("ts"), *outs)


def cumulative_range(counts: DataFrame, keys: Sequence[str], range_: str, step: str, values: Sequence[str] = ("n",),
                     outs: Sequence[str] = ("value",), start=None, end=None, block: str = BLOCK) -> DataFrame:
    """``counter_range`` of cumulative series that have a sample at every step and never
    drop: the first sample of a range stands a fixed number of rows back, in the same
    padded block, so samples are shuffled and sorted once for both questions."""
    keys, outs = list(keys), list(outs)
    r_us, s_us = interval_micros(range_), interval_micros(step)
    early = None if start is None else F.timestamp_add("MICROSECOND", F.lit(-r_us), ntz_literal(start))
    rows = _padded_samples(counts, keys, step, values, outs, early, end, block, r_us)
    _, blk = _blocks_of(step, block)
    w = Window.partitionBy(*keys, "_blk").orderBy("_us")
    back = r_us // s_us
    nth = F.row_number().over(w)
    firsts = [F.when(F.col("_i") > back, F.col(f"_lag_{o}")).otherwise(F.col(f"_top_{o}")).alias(f"first_{o}") for o in outs]
    rows = rows.select(
        "*", nth.alias("_i"), *[F.lag(o, back).over(w).alias(f"_lag_{o}") for o in outs],
        *[F.first(o).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_top_{o}") for o in outs],
    )
    n = F.least(F.col("_i"), F.lit(back + 1)).cast("long")
    mine = blk(F.col("_us")) == F.col("_blk")
    if start is not None:
        mine = mine & (F.col("_us") >= epoch_micros(ntz_literal(start)))
    return rows.filter(mine).select(
        *keys, F.col("_us").alias("t_us"), n.alias("n"), (F.col("_us") - (n - 1) * F.lit(s_us)).alias("first_us"), F.col("_us").alias("last_us"),
        *firsts, *[F.col(o).alias(f"last_{o}") for o in outs], *[F.lit(0.0).alias(f"resets_{o}") for o in outs],
    )


def counter_samples(logs: DataFrame, step: str, keys: Sequence[str] = ("service", "level"),
                    time_col: str = "event_ts", start=None, end=None, block: str = BLOCK) -> DataFrame:
    """``logs_produced_total{labels}`` as scraped at the end of every step:
    (labels, ts, value = logs with event time before ts)."""
    return cumulative_samples(step_counts(logs, step, keys, time_col), keys, step, start=start, end=end, block=block)


def counter_range(samples: DataFrame, keys: Sequence[str], range_: str, step: str, values: Sequence[str] = ("value",),
                  start=None, end=None, block: str = BLOCK) -> DataFrame:
    """Per (labels, t): what the range functions need of the samples in [t - range, t]:
    ``t_us, n, first_us, last_us`` and per value column ``first_*, last_*, resets_*``.

    ``t`` runs over the step grid from a series' first sample, or ``start``, to ``end``
    (by default the last sample time of the table).  Samples of a series with equal times
    count as one, the largest."""
    keys, values = list(keys), list(values)
    r_us, s_us = interval_micros(range_), interval_micros(step)
    b_us, blk = _blocks_of(step, block)
    d = samples
    if end is not None:
        d = d.filter(F.col("ts") <= ntz_literal(end))
    if start is not None:
        d = d.filter(F.col("ts") >= from_epoch_micros(epoch_micros(ntz_literal(start)) - F.lit(r_us)))
    d = d.groupBy(*keys, epoch_micros("ts").alias("_us")).agg(*[F.max(v).alias(v) for v in values])
    own = F.sequence(blk(F.col("_us")), blk(F.col("_us") + F.lit(r_us)), F.lit(b_us))
    rows = d.withColumn("_eval", F.lit(False)).withColumn("_blk", F.explode(own))
    starts = samples.groupBy(*keys).agg(F.min("ts").alias("_s"))
    first = epoch_micros("_s") if start is None else F.greatest(epoch_micros("_s"), epoch_micros(ntz_literal(start)))
    starts = starts.select(*keys, from_epoch_micros(first + F.pmod(-first, F.lit(s_us))).alias("start"))
    last = samples.agg(F.max("ts")).scalar() if end is None else ntz_literal(end)
    times = grid_points(starts, keys, last, step, block).select(*keys, epoch_micros("ts").alias("_us"))
    nulls = [F.lit(None).cast(samples.schema[v].dataType).alias(v) for v in values]
    rows = rows.unionByName(times.select(*keys, "_us", *nulls, F.lit(True).alias("_eval"), blk(F.col("_us")).alias("_blk")))
    w = Window.partitionBy(*keys, "_blk").orderBy("_us")
    frame = w.rangeBetween(-r_us, 0)
    v0 = F.col(values[0])
    at = F.when(v0.isNotNull(), F.col("_us"))
    drops = []
    for v in values:
        prev = F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        drops.append(F.when(F.col(v).isNotNull(), F.when(F.col(v) < prev, prev).otherwise(F.lit(0.0))).alias(f"_c_{v}"))
    out = rows.select("*", *drops).select(
        *keys, F.col("_us").alias("t_us"), "_eval", F.count(v0).over(frame).alias("n"), F.min(at).over(frame).alias("first_us"), F.max(at).over(frame).alias("last_us"),
        *[F.first(v, ignorenulls=True).over(frame).alias(f"first_{v}") for v in values],
        *[F.last(v, ignorenulls=True).over(frame).alias(f"last_{v}") for v in values],
        *[(F.sum(f"_c_{v}").over(frame) - F.first(f"_c_{v}", ignorenulls=True).over(frame)).alias(f"resets_{v}") for v in values],
    )
    return out.filter("_eval").drop("_eval")


def _increase(value: str = "value") -> Column:
    first = F.coalesce(F.col(f"first_{value}"), F.lit(0.0))  # unknown in change_points: then last is the increase
    return F.col(f"last_{value}") - first + F.col(f"resets_{value}")


def counter_increase(samples: DataFrame, keys: Sequence[str], range_: str, step: str, value: str = "value",
                     start=None, end=None, block: str = BLOCK) -> DataFrame:
    """Reset-aware increase inside each range (last - first + the value before each
    drop), without extrapolation; needs two samples in the range."""
    st = counter_range(samples, keys, range_, step, [value], start, end, block).filter(F.col("n") >= 2)
    return st.select(*keys, from_epoch_micros(F.col("t_us")).alias("ts"), "n", _increase(value).alias("increase"))


def extrapolated(range_: str, per_second: bool, value: str = "value") -> Column:
    """Range-function result with edge extrapolation, from ``counter_range`` columns."""
    r_us = interval_micros(range_)
    e6 = F.lit(1e6)
    inc, first = _increase(value), F.col(f"first_{value}")
    si = (F.col("last_us") - F.col("first_us")) / e6
    avg = F.try_divide(si, F.col("n") - F.lit(1))
    d_start = (F.col("first_us") - (F.col("t_us") - F.lit(r_us))) / e6
    d_end = (F.col("t_us") - F.col("last_us")) / e6
    to_zero = si * F.try_divide(first, inc)
    d_start = F.when((inc > 0) & (first >= 0) & (to_zero < d_start), to_zero).otherwise(d_start)
    thr = avg * F.lit(1.1)
    half = avg / F.lit(2.0)
    ext = si + F.when(d_start < thr, d_start).otherwise(half) + F.when(d_end < thr, d_end).otherwise(half)
    out = inc * F.try_divide(ext, si)
    return out / F.lit(r_us / 1e6) if per_second else out


def counter_rate(samples: DataFrame, keys: Sequence[str], range_: str, step: str, value: str = "value",
                 start=None, end=None, block: str = BLOCK) -> DataFrame:
    """Per-second rate of a counter over ``range_`` at every ``step`` (needs two samples
    in the range; otherwise the series has no value at t)."""
    st = counter_range(samples, keys, range_, step, [value], start, end, block).filter(F.col("n") >= 2)
    return st.select(*keys, from_epoch_micros(F.col("t_us")).alias("ts"), extrapolated(range_, True, value).alias("rate"))


def log_increase(logs: DataFrame, range_: str, step: str, keys: Sequence[str] = ("service", "level"), time_col: str = "event_ts",
                 start=None, end=None, block: str = BLOCK) -> DataFrame:
    """``counter_increase`` of ``counter_samples``, straight from raw logs."""
    st = cumulative_range(step_counts(logs, step, keys, time_col), keys, range_, step, start=start, end=end, block=block).filter(F.col("n") >= 2)
    return st.select(*keys, from_epoch_micros(F.col("t_us")).alias("ts"), "n", _increase().alias("increase"))


def log_rates(logs: DataFrame, range_: str, step: str, keys: Sequence[str] = ("service", "level"), time_col: str = "event_ts",
              start=None, end=None, block: str = BLOCK) -> DataFrame:
    """``rate(logs_produced_total[range])``, straight from raw logs, at every step from
    ``start`` to ``end``."""
    st = cumulative_range(step_counts(logs, step, keys, time_col), keys, range_, step, start=start, end=end, block=block).filter(F.col("n") >= 2)
    return st.select(*keys, from_epoch_micros(F.col("t_us")).alias("ts"), extrapolated(range_, True).alias("rate"))


def sum_rates(rates: DataFrame, by: Sequence[str] = (), value: str = "rate", out: str = "value") -> DataFrame:
    """``sum by (by) (rate(...))`` per evaluation time ."""
    return rates.groupBy("ts", *by).agg(F.sum(value).alias(out))


def ratio_of_rates(rates: DataFrame, level_col: str = "level", level: str = ERROR_LEVEL,
                   value: str = "rate", out: str = "value") -> DataFrame:
    """``sum(rate{level=L}) / sum(rate) * 100`` per evaluation time.  No row where no
    series of level L exists (the numerator is empty); NULL where the total is 0."""
    sel = F.col(level_col) == F.lit(level)
    agg = rates.groupBy("ts").agg(
        F.sum(F.when(sel, F.col(value))).alias("_num"),
        F.count(F.when(sel, F.lit(1))).alias("_k"),
        F.sum(value).alias("_den"),
    )
    return agg.filter(F.col("_k") > 0).select("ts", (F.try_divide(F.col("_num"), F.col("_den")) * F.lit(100.0)).alias(out))


def change_points(counts: DataFrame, keys: Sequence[str], range_: str, step: str, values: Sequence[str] = ("n",),
                  outs: Sequence[str] = ("value",), start=None, end=None) -> tuple[DataFrame, DataFrame, Column]:
    """``cumulative_range`` where it is not zero, from per-step counts ``(labels, ts, values)``:
    its rows at the steps whose range holds a count after the series' first step; one row
    per series with its ``start``; and the evaluation's end.

    A count at step u is in the ranges of the next range / step steps, so it is spread over
    them and summed per (series, step), by a partial aggregate: work follows the counts, not
    the steps.  A range that begins before the series does begins with its first sample,
    whose value is the first step's count; the value of any other first sample decides
    nothing, since samples then reach the range's edge, so it is not known here (null)."""
    keys, values, outs = list(keys), list(values), list(outs)
    r_us, s_us = interval_micros(range_), interval_micros(step)
    counts = materialize(counts.select(*keys, "ts", *values), "step-counts")
    last = counts.agg(F.max("ts")).scalar() if end is None else ntz_literal(end)
    starts = counts.groupBy(*keys).agg(F.min("ts").alias("start"), *[F.min_by(v, "ts").alias(f"_s_{v}") for v in values])
    if end is not None:
        starts = starts.filter(F.col("start") <= last)
    u, t = epoch_micros("ts"), F.col("t_us")
    later = counts.join(starts, keys).filter(F.col("ts") > F.col("start"))
    if start is not None:
        later = later.filter(F.col("ts") > from_epoch_micros(epoch_micros(ntz_literal(start)) - F.lit(r_us)))
    spread = later.select(*keys, epoch_micros("start").alias("_s"), *[f"_s_{v}" for v in values], *values, F.explode(F.sequence(u, u + F.lit(r_us - s_us), F.lit(s_us))).alias("t_us"))
    spread = spread.filter(t <= epoch_micros(last))
    if start is not None:
        spread = spread.filter(t >= epoch_micros(ntz_literal(start)))
    sums = spread.groupBy(*keys, "t_us").agg(F.first("_s").alias("_s"), *[F.first(f"_s_{v}").alias(f"_s_{v}") for v in values], *[F.sum(v).alias(v) for v in values])
    first_us = F.greatest(t - F.lit(r_us), F.col("_s"))
    begun = F.col("_s") > t - F.lit(r_us)
    firsts = [F.when(begun, F.col(f"_s_{v}").cast("double")) for v in values]
    points = sums.select(
        *keys, "t_us", ((t - first_us) / F.lit(s_us) + F.lit(1)).cast("long").alias("n"), first_us.alias("first_us"), t.alias("last_us"),
        *[f.alias(f"first_{o}") for f, o in zip(firsts, outs, strict=True)],
        *[(F.coalesce(f, F.lit(0.0)) + F.col(v)).alias(f"last_{o}") for f, v, o in zip(firsts, values, outs, strict=True)],
        *[F.lit(0.0).alias(f"resets_{o}") for o in outs],
    )
    return points, starts.select(*keys, "start"), last


def evaluated_steps(starts: DataFrame, by: Sequence[str], last: Column, step: str, start) -> DataFrame:
    """Steps at which a rate exists: from the step after the first start, per ``by``."""
    first = add_micros(F.min("start"), interval_micros(step))
    begin = starts.groupBy(*by).agg((first if start is None else F.greatest(first, ntz_literal(start))).alias("start"))
    return grid_points(begin.filter(F.col("start").isNotNull()), by, last, step)


def _point_rates(counts: DataFrame, range_: str, step: str, keys: Sequence[str], start, end):
    points, starts, last = change_points(counts, keys, range_, step, start=start, end=end)
    return points.select(*keys, from_epoch_micros(F.col("t_us")).alias("ts"), extrapolated(range_, True).alias("rate")), starts, last


def rate_sums(logs: DataFrame, range_: str, step: str, by: Sequence[str] = (), keys: Sequence[str] = ("service", "level"),
              time_col: str = "event_ts", out: str = "value", start=None, end=None) -> DataFrame:
    """``sum by (by) (rate(logs_produced_total[range]))`` at every step, straight from raw
    logs: ``sum_rates(log_rates(...))`` without a row per series and step."""
    return counts_rate_sums(step_counts(logs, step, keys, time_col), range_, step, by, keys, out, start, end)


def counts_rate_sums(counts: DataFrame, range_: str, step: str, by: Sequence[str] = (), keys: Sequence[str] = ("service", "level"),
                     out: str = "value", start=None, end=None) -> DataFrame:
    """``rate_sums`` from step counts, one row per (labels, ts)."""
    by = list(by)
    rates, starts, last = _point_rates(counts, range_, step, keys, start, end)
    zeros = evaluated_steps(starts, by, last, step, start).withColumn("rate", F.lit(0.0))
    return rates.select(*by, "ts", "rate").unionByName(zeros).groupBy("ts", *by).agg(F.sum("rate").alias(out))


def rate_ratio(logs: DataFrame, range_: str, step: str, level: str = ERROR_LEVEL, keys: Sequence[str] = ("service", "level"),
               time_col: str = "event_ts", out: str = "value", start=None, end=None) -> DataFrame:
    """``ratio_of_rates(log_rates(...))``, straight from raw logs: at every step from which a
    series of ``level`` has a rate; NULL where all rates are zero."""
    return counts_rate_ratio(step_counts(logs, step, keys, time_col), range_, step, level, keys, out, start, end)


def counts_rate_ratio(counts: DataFrame, range_: str, step: str, level: str = ERROR_LEVEL, keys: Sequence[str] = ("service", "level"),
                      out: str = "value", start=None, end=None) -> DataFrame:
    """``rate_ratio`` from step counts, one row per (labels, ts)."""
    rates, starts, last = _point_rates(counts, range_, step, keys, start, end)
    mine = F.col("level") == F.lit(level)
    grid = evaluated_steps(starts.filter(mine), [], last, step, start)
    rows = rates.select("ts", "rate", F.when(mine, F.col("rate")).otherwise(F.lit(0.0)).alias("_num"), F.lit(0).alias("_step"))
    rows = rows.unionByName(grid.select("ts", F.lit(0.0).alias("rate"), F.lit(0.0).alias("_num"), F.lit(1).alias("_step")))
    agg = rows.groupBy("ts").agg(F.sum("_num").alias("_num"), F.sum("rate").alias("_den"), F.max("_step").alias("_step"))
    return agg.filter(F.col("_step") == 1).select("ts", (F.try_divide(F.col("_num"), F.col("_den")) * F.lit(100.0)).alias(out))


def event_rate(logs: DataFrame, range_: str, step: str, keys: Sequence[str] = ("service",),
               time_col: str = "event_ts") -> DataFrame:
    """Events per second in the trailing ``range_`` [t - range, t) at every step t,
    straight from raw logs.  Logs are first counted per step (partial aggregate), then
    the small step table is fanned out to the range/step windows ending on step edges
    (Spark's sliding ``window``) and summed."""
    r_s = interval_micros(range_) / 1e6
    per_step = logs.filter(F.col(time_col).isNotNull()).groupBy(
        *label_cols(keys), F.window(time_col, step).start.alias("b")
    ).agg(F.count(F.lit(1)).alias("n"))
    slid = per_step.groupBy(*keys, F.window("b", range_, step).alias("w")).agg(F.sum("n").alias("events"))
    return slid.select(F.col("w.end").alias("ts"), *keys, "events",
                       (F.col("events") / F.lit(r_s)).alias("rate"))
