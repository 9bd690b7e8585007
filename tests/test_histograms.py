import datetime as dt

import pytest
from pyspark.sql import functions as F

from logmetrics.operators import histograms as H

INF = float("inf")


def q(spark, qv, buckets):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), le, v) for le, v in buckets],
                               "s int, ts timestamp_ntz, le double, rate double")
    return H.histogram_quantile(qv, df, ["s"]).collect()[0].value


@pytest.mark.parametrize("qv,buckets,want", [
    (0.5, [(0.1, 10.0), (0.5, 20.0), (INF, 20.0)], 0.1),            # first bucket
    (0.75, [(0.1, 10.0), (0.5, 20.0), (INF, 20.0)], 0.3),           # interpolated
    (0.9, [(0.1, 10.0), (0.5, 20.0), (INF, 30.0)], 0.5),            # +Inf bucket: largest finite bound
    (0.1, [(-1.0, 5.0), (1.0, 10.0), (INF, 10.0)], -1.0),           # first bound <= 0
    (0.5, [(0.1, 10.0), (0.5, 8.0), (INF, 12.0)], 0.06),            # made monotonic first
    (0.5, [(0.1, 0.0), (0.5, 0.0), (INF, 0.0)], None),              # no observations
    (0.5, [(0.1, 1.0), (0.5, 2.0)], None),                          # no +Inf bucket
    (0.5, [(INF, 4.0)], None),                                      # fewer than two buckets
])
def test_bucket_quantile(spark, qv, buckets, want):
    got = q(spark, qv, buckets)
    assert got == (pytest.approx(want) if want is not None else None)


def test_cumulative_histogram(spark):
    df = spark.createDataFrame([(x,) for x in [50, 100, 150, 5000, 7000]], "x int")
    got = {r.le: r.bucket_count for r in H.histogram(df, F.col("x"), [100.0, 200.0, 5000.0]).collect()}
    assert got == {100.0: 2, 200.0: 3, 5000.0: 4, INF: 5}
