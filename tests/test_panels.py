"""Panels from stored steps and bases equal the evaluation over all logs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logmetrics.operators import counters as C
from logmetrics.session import scratch_path
from logmetrics.sources import versions as V
from logmetrics.streaming import panels as P

SCHEMA = "event_time timestamp_ntz, service string, level string"
T = dt.datetime(2024, 5, 1, 22)


def logs(spark, seed=3, days=(0, 1, 1, 4, 5), size=60):
    """A batch per entry of ``days``; some logs come days late, into dates that have steps
    and into one (the third) that has none; one series begins with the last batch."""
    r, parts = random.Random(seed), []
    for k, day in enumerate(days):
        rows = []
        for _ in range(size):
            back = r.choice([0, 0, 0, 0, 1, 2, 3]) if k > 1 else 0
            at = T + dt.timedelta(days=day - min(back, day), seconds=r.uniform(0, 3 * 3600))
            rows.append((at, r.choice(["a", "b", None]), r.choice(["ERROR", "INFO"])))
        rows.append((None, "a", "INFO"))
        parts.append(rows)
    parts[-1] += [(T + dt.timedelta(days=days[-1], hours=2.5, seconds=7 * i), "late", "ERROR") for i in range(9)]
    return [spark.createDataFrame(rows, SCHEMA) for rows in parts]


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_panels_equal_full_evaluation(spark):
    parts, root = logs(spark), scratch_path(spark, "t-panels")
    for k, part in enumerate(parts):
        P.panel_writer(root, compact_every=3 if k else 0)(part, k)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    newest = P.panel_range(V.newest(spark, root))[1]
    for range_, end in (("2 hours", newest), ("15 minutes", T + dt.timedelta(days=3, hours=1)), ("3 days", newest - dt.timedelta(hours=1))):
        start = P.panel_range(V.newest(spark, root), range_, end)[0]
        at = {"time_col": "event_time", "start": start, "end": end}
        assert rows(P.panel_samples(spark, root, range_, end=end)) == rows(C.counter_samples(whole, "15 seconds", **at))
        assert rows(P.panel_rate_sums(spark, root, "5 minutes", range_, by=["service"], end=end)) == rows(C.rate_sums(whole, "5 minutes", "15 seconds", ["service"], **at))
        assert rows(P.panel_rate_ratio(spark, root, "1 minute", range_, end=end)) == rows(C.rate_ratio(whole, "1 minute", "15 seconds", **at))


def test_a_panel_reads_its_range_whatever_the_history(spark):
    root, read = scratch_path(spark, "t-panels"), []
    for k in range(4):
        at = T + dt.timedelta(days=k)
        batch = spark.createDataFrame([(at + dt.timedelta(minutes=i), "a", "INFO") for i in range(30)], SCHEMA)
        P.panel_writer(root)(batch, k)
        found = P.panel_samples(spark, root)
        assert found.agg(F.max("value")).first()[0] == 30 * (k + 1)
        version = V.newest(spark, root)
        read.append(len(P.step_folders(version, *P.panel_range(version))))
        assert P.base_at(spark, version, at + dt.timedelta(minutes=5)).first().n == 30 * k + 5
    assert read == [1, 1, 1, 1]
    inputs = P.base_at(spark, version, at).inputFiles()
    assert inputs and all(f"date_of_row={at.date()}" in f for f in inputs)


def test_batches_that_die_or_come_again_count_once(spark, monkeypatch):
    parts, root = logs(spark, 5), scratch_path(spark, "t-panels")
    P.panel_writer(root)(parts[0], 0)
    before = rows(P.panel_samples(spark, root, "1 day"))

    def dies(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(V, "commit", dies)
        with pytest.raises(RuntimeError, match="killed"):
            P.panel_writer(root)(parts[1], 1)
    assert rows(P.panel_samples(spark, root, "1 day")) == before
    for _ in range(2):
        P.panel_writer(root)(parts[1], 1)
    whole = parts[0].unionByName(parts[1]).where("event_time is not null").count()
    assert P.panel_samples(spark, root).where(F.col("ts") == P.panel_range(V.newest(spark, root))[1]).agg(F.sum("value")).first()[0] == whole


def test_empty_batches_and_tables(spark):
    root = scratch_path(spark, "t-panels")
    P.panel_writer(root)(spark.createDataFrame([(None, "a", "INFO")], SCHEMA), 0)
    assert P.panel_samples(spark, root).count() == P.panel_rate_sums(spark, root, "1 minute").count() == P.panel_rate_ratio(spark, root, "1 minute").count() == 0
