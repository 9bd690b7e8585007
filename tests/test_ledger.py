"""Every record of a disordered stream is emitted, open, late or unreadable, once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logmetrics.config import LOG_COLUMNS
from logmetrics.session import scratch_path
from logmetrics.sources import versions as V
from logmetrics.streaming import ledger as LG

SCHEMA = "timestamp string, service string, level string, response_time_ms int, kafka_timestamp timestamp_ntz"
T = dt.datetime(2024, 5, 1, 10)


def batches(seed=1, n=5, size=120):
    """Records whose times wander; some far behind, some unreadable."""
    r, out = random.Random(seed), []
    for k in range(n):
        rows = []
        for _ in range(size):
            at = T + dt.timedelta(seconds=k * 300 + r.uniform(0, 300) - (r.uniform(0, 900) if r.random() < 0.2 else 0))
            stamp = r.choice([None, "bad", "2024-13-01T00:00:00Z"]) if r.random() < 0.1 else at.isoformat(timespec="microseconds") + "Z"
            rows.append((stamp, r.choice(["a", "b", None]), r.choice(["ERROR", "INFO"]), r.choice([None, r.randrange(500)]), at))
        out.append(rows)
    return out


def expected(parts, wide=60, delay=120):
    """One record at a time, by the rule itself."""
    newest, fates, windows = None, [], {}
    for rows in parts:
        mark = newest and newest - dt.timedelta(seconds=delay)
        for stamp, service, level, ms, _ in rows:
            try:
                at = dt.datetime.fromisoformat(stamp.rstrip("Z"))
            except (AttributeError, ValueError):
                fates.append("unreadable")
                continue
            start = at - (at - dt.datetime(2024, 1, 1)) % dt.timedelta(seconds=wide)
            newest = max(newest or at, at)
            if mark is not None and start + dt.timedelta(seconds=wide) <= mark:
                fates.append("late")
            else:
                windows.setdefault((start, service, level), []).append(ms)
    mark = newest - dt.timedelta(seconds=delay)
    closed = {k: v for k, v in windows.items() if k[0] + dt.timedelta(seconds=wide) <= mark}
    return fates, closed, {k: v for k, v in windows.items() if k not in closed}


def run(spark, root, parts, first=0):
    for k, rows in enumerate(parts, first):
        LG.ledger_writer(root, "1 minute", "2 minutes")(spark.createDataFrame(rows, SCHEMA), k)


def test_balance_equals_one_record_at_a_time(spark):
    parts, root = batches(), scratch_path(spark, "t-ledger")
    run(spark, root, parts)
    fates, closed, left = expected(parts)
    got = {}
    for r in LG.balance(spark, root).collect():
        got[r.fate] = got.get(r.fate, 0) + r.rows
    assert got == {"emitted": sum(map(len, closed.values())), "open": sum(map(len, left.values())), "late": fates.count("late"), "unreadable": fates.count("unreadable")}
    assert min(got.values()) > 0 and sum(got.values()) == sum(map(len, parts))
    windows = LG.emitted_windows(spark, root).collect()
    assert {(w.window_start, w.service, w.level): w.log_count for w in windows} == {k: len(v) for k, v in closed.items()}
    assert len(windows) == len(closed)  # each once
    for w in windows:
        ms = sorted(x for x in closed[w.window_start, w.service, w.level] if x is not None)
        assert (w.p50 is None) == (not ms) and (not ms or w.p50 == ms[-(-len(ms) // 2) - 1])
    rows = LG.ledger(spark, root).collect()
    assert all(r.input == r.on_time + r.late + r.unreadable for r in rows) and len(rows) == len(parts)
    late = LG.late_records(spark, root)
    assert late.where("fate = 'late'").where(F.col("event_time").isNull()).count() == 0


def test_batches_that_die_or_come_again_count_once(spark, monkeypatch):
    parts, root = batches(2, 3, 60), scratch_path(spark, "t-ledger")
    run(spark, root, parts[:2])
    run(spark, root, parts[1:2], 1)
    before = sorted(map(tuple, LG.balance(spark, root).collect()), key=repr)

    def dies(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(V, "commit", dies)
        with pytest.raises(RuntimeError, match="killed"):
            run(spark, root, parts[2:], 2)
    assert sorted(map(tuple, LG.balance(spark, root).collect()), key=repr) == before
    run(spark, root, parts[2:], 2)
    assert sum(r.rows for r in LG.balance(spark, root).collect()) == 180


def test_empty_batches_and_only_unreadable_ones(spark):
    root = scratch_path(spark, "t-ledger")
    run(spark, root, [[], [("bad", "a", "INFO", 1, T)]][1:], 1)
    LG.ledger_writer(root, "1 minute")(spark.createDataFrame([], SCHEMA), 2)
    assert [tuple(r) for r in LG.balance(spark, root).collect()] == [("unreadable", "a", 1)]
    assert LG.ledger(spark, root).count() == 1 and LG.emitted_windows(spark, root).count() == 0
    assert "timestamp" in LOG_COLUMNS
