"""Range functions against a plain-Python statement of the same rules on small,
hand-made counter series (constant slope, a reset, a lone sample, a wide gap, a
counter starting near zero)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from logmetrics.functions.text import significant
from logmetrics.operators import counters as C

T0 = dt.datetime(2024, 1, 1)
STEP, RANGE = 15, 60


def ref_rate(samples, t, r, per_second=True):
    pts = [(ts, v) for ts, v in samples if t - r <= ts <= t]
    if len(pts) < 2:
        return None
    corr, last = 0.0, 0.0
    for _, v in pts:
        if v < last:
            corr += last
        last = v
    inc = pts[-1][1] - pts[0][1] + corr
    si = float(pts[-1][0] - pts[0][0])
    avg = si / (len(pts) - 1)
    d_start, d_end = float(pts[0][0] - (t - r)), float(t - pts[-1][0])
    if inc > 0 and pts[0][1] >= 0:
        d_start = min(d_start, si * (pts[0][1] / inc))
    ext = si + (d_start if d_start < avg * 1.1 else avg / 2) + (d_end if d_end < avg * 1.1 else avg / 2)
    out = inc * (ext / si)
    return out / r if per_second else out


CASES = {
    "slope": [(15 * i, 10.0 * i) for i in range(12)],
    "reset": [(0, 0.0), (15, 10.0), (30, 20.0), (45, 5.0), (60, 15.0), (75, 25.0), (90, 3.0), (105, 9.0)],
    "lone": [(30, 7.0)],
    "gap": [(0, 1.0), (15, 2.0), (30, 3.0), (120, 9.0), (135, 10.0)],
    "near_zero": [(20, 1.0), (35, 11.0), (50, 21.0), (65, 31.0)],
}


@pytest.fixture(scope="module")
def samples(spark):
    rows = [(name, "x", T0 + dt.timedelta(seconds=ts), v) for name, pts in CASES.items() for ts, v in pts]
    return spark.createDataFrame(rows, "service string, level string, ts timestamp_ntz, value double")


def test_counter_rate_matches_rules(spark, samples):
    got = {(r.service, int((r.ts - T0).total_seconds())): r.rate
           for r in C.counter_rate(samples, ["service", "level"], "1 minute", "15 seconds").collect()}
    t_end = max(ts for pts in CASES.values() for ts, _ in pts)
    want = {}
    for name, pts in CASES.items():
        t = 0
        while t <= t_end:
            v = ref_rate(pts, t, RANGE)
            if v is not None:
                want[(name, t)] = v
            t += STEP
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12), k
    assert not any(k[0] == "lone" for k in got)


def test_counter_increase_is_reset_aware(spark, samples):
    got = {(r.service, int((r.ts - T0).total_seconds())): r.increase
           for r in C.counter_increase(samples, ["service", "level"], "1 minute", "15 seconds").collect()}
    # range [45, 105] holds 5, 15, 25, 3, 9: (9 - 5) + 25 for the drop to 3
    assert got[("reset", 105)] == 29.0
    assert got[("slope", 60)] == 40.0


def test_counter_samples_dense_and_cumulative(spark):
    rows = [(T0 + dt.timedelta(minutes=m), s) for m, s in [(1, "a"), (2, "a"), (61, "a"), (150, "b")]]
    logs = spark.createDataFrame(rows, "event_ts timestamp_ntz, service string").withColumn("level", C.F.lit("INFO"))
    got = sorted((r.service, r.ts, r.value) for r in C.counter_samples(logs, "1 hour", block="2 hours").collect())
    h = [T0 + dt.timedelta(hours=i) for i in range(4)]
    assert got == [("a", h[1], 2.0), ("a", h[2], 3.0), ("a", h[3], 3.0), ("b", h[3], 1.0)]


def test_ratio_of_rates_absent_without_numerator(spark):
    df = spark.createDataFrame([(T0, "INFO", 1.0), (T0, "ERROR", 1.0), (T0 + dt.timedelta(seconds=15), "INFO", 2.0)],
                               "ts timestamp_ntz, level string, rate double")
    got = {r.ts: r.value for r in C.ratio_of_rates(df).collect()}
    assert got == {T0: 50.0}


def test_event_rate_windows(spark):
    rows = [(T0 + dt.timedelta(seconds=s), "a") for s in (1, 14, 16, 70)]
    logs = spark.createDataFrame(rows, "event_ts timestamp_ntz, service string")
    got = {int((r.ts - T0).total_seconds()): r.events for r in C.event_rate(logs, "1 minute", "15 seconds").collect()}
    # window [t - 60, t): events at 1 and 14 are in step [0, 15), 16 in [15, 30), 70 in [60, 75)
    assert got == {15: 2, 30: 3, 45: 3, 60: 3, 75: 2, 90: 1, 105: 1, 120: 1}


def test_duplicate_times_count_as_the_largest(spark):
    rows = [("a", T0 + dt.timedelta(seconds=s), v) for s, v in [(0, 1.0), (15, 4.0), (15, 6.0), (30, 6.0), (30, 6.0), (45, 9.0)]]
    rows += [("b", T0, 2.0), ("b", T0, 2.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double")
    got = {(r.k, int((r.ts - T0).total_seconds())): r.rate for r in C.counter_rate(df, ["k"], "1 minute", "15 seconds").collect()}
    pts = [(0, 1.0), (15, 6.0), (30, 6.0), (45, 9.0)]
    assert set(got) == {("a", 15), ("a", 30), ("a", 45)}
    for t in (15, 30, 45):
        assert got["a", t] == pytest.approx(ref_rate(pts, t, RANGE), rel=1e-12)


def test_block_edges_change_nothing(spark, samples):
    keys = ["service", "level"]
    whole = {tuple(r) for r in C.counter_rate(samples, keys, "1 minute", "15 seconds").collect()}
    assert {tuple(r) for r in C.counter_rate(samples, keys, "1 minute", "15 seconds", block="30 seconds").collect()} == whole


def test_evaluation_range(spark):
    """With start and end, the rows are those of the whole evaluation in that range."""
    logs = spark.createDataFrame([(T0 + dt.timedelta(seconds=7 * i * i % 900), f"s{i % 2}", "INFO") for i in range(60)], "event_ts timestamp_ntz, service string, level string")
    start, end = T0 + dt.timedelta(seconds=300), T0 + dt.timedelta(seconds=600)
    for f in (lambda **k: C.log_rates(logs, "1 minute", "15 seconds", **k), lambda **k: C.counter_samples(logs, "15 seconds", **k)):
        whole = {tuple(r) for r in f().collect() if start <= r.ts <= end}
        part = {tuple(r) for r in f(start=start, end=end).collect()}
        assert part == whole and part
    dense = C.counter_samples(logs, "15 seconds")
    a = {tuple(r) for r in C.counter_rate(dense, ["service", "level"], "1 minute", "15 seconds", start=start, end=end).collect()}
    assert a == {tuple(r) for r in C.log_rates(logs, "1 minute", "15 seconds", start=start, end=end).collect()}


def test_sums_keep_small_terms_and_nan(spark):
    rows = [(T0, 4e-12) for _ in range(1000)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, rate double")
    assert C.sum_rates(df).first().value == pytest.approx(4e-9, rel=1e-12)
    nan = spark.createDataFrame([*rows, (T0, float("nan"))], "ts timestamp_ntz, rate double")
    assert math.isnan(C.sum_rates(nan).first().value)


def test_significant(spark):
    df = spark.createDataFrame([(1.23456789012e-7,), (float("nan"),), (None,), (0.0,), (-5e20 / 3,)], "x double")
    got = [r.y for r in df.select(significant(F.col("x")).alias("y")).collect()]
    assert got[0] == 1.23456789e-7 and math.isnan(got[1]) and got[2] is None and got[3] == 0.0 and got[4] == -1.66666667e20


def test_log_ranges_equal_the_general_operator(spark):
    logs = spark.createDataFrame([(T0 + dt.timedelta(seconds=11 * i * i % 1900), f"s{i % 2}", "INFO") for i in range(90)], "event_ts timestamp_ntz, service string, level string")
    keys = ["service", "level"]
    dense = C.counter_samples(logs, "15 seconds")
    for block in ("1 day", "90 seconds"):
        a = {(r.service, r.ts): r.rate for r in C.log_rates(logs, "1 minute", "15 seconds", block=block).collect()}
        b = {(r.service, r.ts): r.rate for r in C.counter_rate(dense, keys, "1 minute", "15 seconds").collect()}
        assert set(a) == set(b) and all(a[k] == pytest.approx(b[k], rel=1e-12) for k in a)
        a = {tuple(r) for r in C.log_increase(logs, "1 minute", "15 seconds", block=block).collect()}
        assert a == {tuple(r) for r in C.counter_increase(dense, keys, "1 minute", "15 seconds").collect()}
