"""The block-split window helper against whole-series brute force, with blocks much
smaller than the series so that block edges are crossed many times."""

import datetime as dt

from logmetrics.operators.blocks import blocked_lead

T0 = dt.datetime(2024, 1, 1)


def test_blocked_helpers(spark):
    rows = []
    for k, (key, gap) in enumerate([("a", 7), ("b", 23), (None, 61)]):
        for i in range(60):
            rows.append((key, T0 + dt.timedelta(minutes=gap * i + k), float((i * 37) % 11)))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    ld = {(r.k, r.ts): r.nxt for r in blocked_lead(df, ["k"], "ts", "v", "nxt", "1 hour").collect()}
    for key in ("a", "b", None):
        pts = sorted((ts, v) for k, ts, v in rows if k == key)
        for i, (ts, _) in enumerate(pts):
            assert ld[(key, ts)] == (pts[i + 1][1] if i + 1 < len(pts) else None)
    assert len(ld) == len(rows)
