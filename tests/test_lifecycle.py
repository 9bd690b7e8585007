"""Versions and retention: rows are in one table, and died or repeated runs change nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logmetrics.session import scratch_path
from logmetrics.sources import lifecycle as L
from logmetrics.sources import versions as V
from logmetrics.sources.archive import retention_tiers

SCHEMA = "i bigint, event_ts timestamp_ntz"
T = dt.datetime(2024, 3, 1, 12)


def logs_of(spark, ids):
    """One log every five hours, counted back from T; id 0 has no time."""
    return spark.createDataFrame([(i, T - dt.timedelta(hours=5 * i) if i else None) for i in ids], SCHEMA)


def ids(spark, root, table, **kw):
    return sorted(r.i for r in L.scan(spark, root, table, SCHEMA, **kw).collect())


def test_three_advancing_runs(spark):
    root = scratch_path(spark, "t-life")
    logs = logs_of(spark, range(240))
    L.ingest(logs, root)
    L.ingest(logs, root)  # the same batch again
    assert ids(spark, root, L.HOT) == list(range(240))
    for days in (0, 3, 3, 17):
        as_of = T + dt.timedelta(days=days)
        L.apply_retention(spark, root, SCHEMA, as_of, hot_days=10)
        tiers = retention_tiers(logs.where("event_ts IS NOT NULL"), as_of, topic_days=0, hot_days=10)
        old = sorted(r.i for r in tiers.where("tier = 'archive'").collect())
        assert ids(spark, root, L.ARCHIVE) == old
        assert ids(spark, root, L.HOT) == sorted(set(range(240)) - set(old))
    day = (T - dt.timedelta(days=20)).date()
    assert ids(spark, root, L.ARCHIVE, start=day, stop=day) == [r.i for r in logs.where(F.to_date("event_ts") == F.lit(day)).orderBy("i").collect()]


def test_expired_rows_leave_with_the_same_commit(spark):
    root = scratch_path(spark, "t-expire")
    L.ingest(logs_of(spark, range(240)), root)
    for days in (0, 2, 5):
        as_of = T + dt.timedelta(days=days)
        v = L.apply_retention(spark, root, SCHEMA, as_of, hot_days=10, archive_days=30)
        age = {i: as_of - (T - dt.timedelta(hours=5 * i)) for i in range(1, 240)}
        assert ids(spark, root, L.ARCHIVE) == [i for i in age if dt.timedelta(days=10) < age[i] <= dt.timedelta(days=30)]
        assert ids(spark, root, L.HOT) == [0] + [i for i in age if age[i] <= dt.timedelta(days=10)]
        assert sum(e.rows for e in v.entries if e.tab) == len(ids(spark, root, L.HOT)) + len(ids(spark, root, L.ARCHIVE))
    assert L.apply_retention(spark, root, SCHEMA, T, hot_days=10, archive_days=30).number == v.number  # an earlier time moves nothing


def test_a_run_that_dies_loses_and_doubles_nothing(spark, monkeypatch):
    root = scratch_path(spark, "t-die")
    L.ingest(logs_of(spark, range(100)), root)
    write, calls = V.write_dates, []

    def dying(rows, *args):
        calls.append(1)
        made = write(rows, *args)
        if len(calls) == kill:
            raise RuntimeError("killed")
        return made

    for kill in (1, 2):  # after the archive's write, after the hot table's
        calls.clear()
        monkeypatch.setattr(V, "write_dates", dying)
        with pytest.raises(RuntimeError, match="killed"):
            L.apply_retention(spark, root, SCHEMA, T, hot_days=10)
        assert ids(spark, root, L.HOT) == list(range(100)) and ids(spark, root, L.ARCHIVE) == []
    monkeypatch.setattr(V, "write_dates", write)
    L.apply_retention(spark, root, SCHEMA, T, hot_days=10)
    assert ids(spark, root, L.ARCHIVE) == list(range(49, 100))
    assert sorted(ids(spark, root, L.HOT) + ids(spark, root, L.ARCHIVE)) == list(range(100))


def test_late_rows_move_with_the_next_run_and_dates_compact(spark):
    root = scratch_path(spark, "t-late")
    L.ingest(logs_of(spark, range(0, 100, 2)), root, work=0)
    L.apply_retention(spark, root, SCHEMA, T, hot_days=10)
    L.ingest(logs_of(spark, range(1, 100, 2)), root, work=1)
    before = L.apply_retention(spark, root, SCHEMA, T, hot_days=10)
    assert ids(spark, root, L.ARCHIVE) == list(range(49, 100))
    for table in (L.HOT, L.ARCHIVE):
        after = L.compact(spark, root, table, SCHEMA)
    assert len({e.date for e in after.entries if e.tab}) < len(before.entries)
    for table in (L.HOT, L.ARCHIVE):
        dates = [e.date for e in after.of(table)]
        assert len(dates) == len(set(dates))
        assert ids(spark, root, table) == ids(spark, root, table, version=before.number)


def test_commits_of_two_writers_and_of_one_that_died(spark):
    root = scratch_path(spark, "t-two")
    L.ingest(logs_of(spark, [1]), root, "a", 0)
    entry = V.write_dates(logs_of(spark, [2]), root, L.HOT, "event_ts")
    seen = []

    def slow(base):
        seen.append(base.number)
        if len(seen) == 1:  # another writer commits between this one's read and write
            L.ingest(logs_of(spark, [3]), root, "b", 0)
        return entry, []

    V.commit(spark, root, slow, "c", 0)
    assert seen == [1, 2] and ids(spark, root, L.HOT) == [1, 2, 3]
    spark.createDataFrame([], "x int").write.json(f"{root}/manifests/v={4:012d}")  # a folder without a manifest
    L.ingest(logs_of(spark, [4]), root, "a", 1)
    assert V.newest(spark, root).number == 5 and ids(spark, root, L.HOT) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="not in version"):
        V.commit(spark, root, lambda _: ([], [V.Entry(tab="hot", path="nowhere")]))


def test_vacuum_keeps_what_kept_versions_name(spark):
    root = scratch_path(spark, "t-vac")
    for k in range(4):
        L.ingest(logs_of(spark, [2 * k, 2 * k + 1]), root, work=k)
    L.compact(spark, root, L.HOT, SCHEMA)
    want = ids(spark, root, L.HOT)
    assert V.vacuum(spark, root, keep=10) == []
    gone = V.vacuum(spark, root, keep=1)
    assert ids(spark, root, L.HOT) == want and gone
    with pytest.raises(ValueError, match="not kept"):
        V.newest(spark, root, 1)
    for path in gone:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.schema(SCHEMA).parquet(path)


def test_empty_tables(spark):
    root = scratch_path(spark, "t-none")
    assert V.newest(spark, root).number == 0 and ids(spark, root, L.HOT) == []
    v = L.ingest(logs_of(spark, []), root)
    assert v.number == 1 and V.newest(spark, root).entries == v.entries
    assert L.apply_retention(spark, root, SCHEMA, T).number == 1 and ids(spark, root, L.ARCHIVE) == []


def test_boundaries_hold_to_the_microsecond(spark):
    root, us = scratch_path(spark, "t-us"), dt.timedelta(microseconds=1)
    edge = T - dt.timedelta(days=10) + 123_456 * us
    rows = [(k, edge + k * us) for k in (-2, -1, 0, 1)]
    L.ingest(spark.createDataFrame(rows, SCHEMA), root)
    L.apply_retention(spark, root, SCHEMA, edge + dt.timedelta(days=10), hot_days=10)
    assert ids(spark, root, L.HOT) == [0, 1] and ids(spark, root, L.ARCHIVE) == [-2, -1]
    assert [(e.low, e.high) for e in V.newest(spark, root).of(L.HOT)] == [(edge, edge + us)]
