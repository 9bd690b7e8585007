import datetime as dt

from logmetrics.operators import series as S

T0 = dt.datetime(2024, 1, 1)


def h(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_resample_last_lookback(spark):
    pts = {"a": [(0, 1.0), (10, 2.0), (50, 3.0)], "b": [(20, 7.0)]}
    df = spark.createDataFrame([(k, h(m), v) for k, p in pts.items() for m, v in p],
                               "service string, ts timestamp_ntz, value double")
    got = {(r.service, int((r.ts - T0).total_seconds() // 60)): r.value
           for r in S.resample_last(df, ["service"], "5 minutes", "15 minutes").collect()}
    want = {}
    end = 50
    for k, p in pts.items():
        for t in range(p[0][0], end + 1, 5):
            live = [(m, v) for m, v in p if t - 15 < m <= t]
            if live:
                want[(k, t)] = max(live)[1]
    assert got == want


def test_gateway_scrape_drops_vanished_series(spark):
    rows = [(1, h(0), "m", "a", None, None, 1.0), (1, h(0), "m", "b", None, None, 2.0),
            (2, h(20), "m", "a", None, None, 5.0)]
    hist = spark.createDataFrame(rows, "batch_id long, ts timestamp_ntz, metric string, service string, "
                                       "level string, percentile string, value double")
    got = sorted((int((r.ts - T0).total_seconds() // 60), r.service, r.value)
                 for r in S.gateway_scrape(hist, "10 minutes").collect())
    assert got == [(0, "a", 1.0), (0, "b", 2.0), (10, "a", 1.0), (10, "b", 2.0), (20, "a", 5.0)]
    latest = sorted((r.service, r.value) for r in S.latest_batch(hist).collect())
    assert latest == [("a", 5.0)]


def test_select_reduce_label(spark):
    rows = [(1, h(0), "spark_latency_ms", "a", None, "p95", 10.0), (2, h(1), "spark_latency_ms", "a", None, "p95", None),
            (1, h(0), "spark_logs_per_batch", "a", "INFO", None, 3.0)]
    hist = spark.createDataFrame(rows, "batch_id long, ts timestamp_ntz, metric string, service string, "
                                       "level string, percentile string, value double")
    assert S.select_series(hist, metric="spark_latency_ms", percentile=["p95"]).count() == 2
    red = {r.metric: (r.last_value, r.mean_value, r.max_value) for r in S.reduce_series(hist).collect()}
    assert red["spark_latency_ms"] == (10.0, 10.0, 10.0)
    labels = sorted(r.label for r in S.label_series(hist).collect())
    assert labels == ["a - INFO", "a P95", "a P95"]


def test_time_range_with_as_of(spark):
    df = spark.createDataFrame([(h(m), float(m)) for m in (0, 10, 20, 30)], "ts timestamp_ntz, value double")
    got = sorted(r.value for r in S.time_range(df, "15 minutes", as_of=h(25)).collect())
    assert got == [10.0, 20.0]
    assert sorted(r.value for r in S.time_range(df, "10 minutes").collect()) == [20.0, 30.0]
