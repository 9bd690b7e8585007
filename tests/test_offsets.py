"""Lost and repeated offsets are reported exactly."""

import datetime as dt
import random

import pytest

from logmetrics.session import scratch_path
from logmetrics.sources import versions as V
from logmetrics.sources.streams import PLACE_SCHEMA, read_log_stream
from logmetrics.streaming import offsets as OF

T = dt.datetime(2024, 5, 1)


def records(spark, places):
    return spark.createDataFrame([(b"{}", T, p, o) for p, o in places], PLACE_SCHEMA)


def expected(parts):
    """Offset by offset."""
    count, out = {}, set()
    for p, o in (x for part in parts for x in part):
        if p is not None and o is not None:
            count.setdefault(p, {}).setdefault(o, 0)
            count[p][o] += 1
    for p, seen in count.items():
        for fault, has in (("lost", lambda o: o not in seen), ("repeated", lambda o: seen.get(o, 0) > 1)):  # noqa: B023
            first = None
            for o in range(min(seen), max(seen) + 2):
                if o <= max(seen) and has(o):
                    first = o if first is None else first
                elif first is not None:
                    out.add((p, fault, first, o - 1))
                    first = None
    return out


def found(spark, root):
    rows = [tuple(r) for r in OF.faults(OF.read_ranges(spark, root)).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_faults_equal_offset_by_offset(spark, seed):
    """Gaps, repeats within and between batches, late batches, edges of blocks of 8."""
    r, root = random.Random(seed), scratch_path(spark, "t-offsets")
    parts = [[(p, o) for p in (0, 1) for o in range(k * 30, k * 30 + 30) if r.random() > 0.1] for k in (0, 2, 1, 3)]
    for part in parts[1:]:
        part += r.choices(parts[0] + part, k=8) + [(None, 3), (0, None)]
    for k, part in enumerate(parts):
        OF.range_writer(root, block=8)(records(spark, part), k)
    want = expected(parts)
    assert found(spark, root) == want and {f for _, f, _, _ in want} == {"lost", "repeated"}


def test_a_topic_without_faults_is_one_range_a_batch(spark):
    root = scratch_path(spark, "t-offsets")
    for k in range(3):
        OF.range_writer(root, block=8)(records(spark, [(0, o) for o in range(k * 50, k * 50 + 50)]), k)
    OF.range_writer(root)(records(spark, []), 3)
    assert OF.read_ranges(spark, root).count() == 3 and not found(spark, root)


def test_retried_batches_count_once(spark, monkeypatch):
    root, part = scratch_path(spark, "t-offsets"), [(0, 1), (0, 2), (0, 5)]

    def dies(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(V, "commit", dies)
        with pytest.raises(RuntimeError, match="killed"):
            OF.range_writer(root)(records(spark, part), 0)
    for _ in range(2):
        OF.range_writer(root)(records(spark, part), 0)
    assert found(spark, root) == {(0, "lost", 3, 4)}


def test_stream_of_a_file_stand_in(spark):
    """A gap and a repeat over a restart."""
    root = scratch_path(spark, "t-offsets")
    for lo, hi in ((0, 20), (25, 40), (38, 50)):
        records(spark, [(2, o) for o in range(lo, hi)]).write.mode("append").parquet(f"{root}/wire")
        stream = read_log_stream(spark, "parquet", f"{root}/wire", offsets=True)
        OF.start_offset_ledger(stream, f"{root}/ledger", f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    assert found(spark, f"{root}/ledger") == {(2, "lost", 20, 24), (2, "repeated", 38, 39)}
