"""Results must not depend on the session time zone (event time is UTC wall clock)."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

NAMES = ["parse_logs", "window_5m", "ingest_delay", "daily_report", "counter_samples", "event_rate_1m",
         "metrics_history", "retention_split"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_in_any_zone(spark, name):
    def run():
        df = E.queries()[name](spark, SF_SMALL)
        return sorted(map(tuple, df.collect()), key=repr)

    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == utc
