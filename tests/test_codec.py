import datetime as dt
import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from logmetrics.config import LOG_COLUMNS
from logmetrics.functions.text import payload_bytes
from logmetrics.operators.windows import ingest_delay, with_event_time
from logmetrics.sources.codec import encode_logs, log_schema, parse_logs, wire_records
from logmetrics.sources.fixtures import load_logs, logs_from_events
from logmetrics.streaming.stateful import with_event_instant

from conftest import SF_SMALL

FULL = {"timestamp": "2024-01-01T00:09:58.778549Z", "level": "ERROR", "service": "auth-service", "host": "host-4",
        "request_id": "req-00000000", "trace_id": "trace-100000", "http_method": "GET",
        "http_path": "/api/v1/orders", "http_status": 503, "response_time_ms": 185, "client_ip": "10.0.14.1",
        "message": "Load test log"}


def _parse(spark, values):
    rows = [(None if v is None else v.encode() if isinstance(v, str) else v,) for v in values]
    wire = spark.createDataFrame(rows, "value binary").withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    return [r.asDict() for r in parse_logs(wire).collect()]


def test_edge_rows(spark):
    all_null = {c: None for c in LOG_COLUMNS}
    values = [
        json.dumps({**FULL, "extra": 1}),
        "not json", '{"level": "INFO"', "{}", "[]", json.dumps([FULL, FULL]), None, "",
        '{"level":"X"}{"level":"Y"}',
        '{"level":"INFO","http_status":"abc","response_time_ms":7}',
        '{"response_time_ms":"42"}', '{"response_time_ms":12.5}', '{"response_time_ms":99999999999}',
        '{"level":5,"service":{"x":1}}',
        '{"Level":"case"}',
    ]
    out = _parse(spark, values)
    assert len(out) == len(values)  # every record is kept and counted
    strip = [{c: r[c] for c in LOG_COLUMNS} for r in out]
    assert strip[0] == {**all_null, **FULL}
    for i in range(1, 8):
        assert strip[i] == all_null, values[i]
    assert strip[8]["level"] == "X"
    assert strip[9]["level"] == "INFO" and strip[9]["http_status"] is None and strip[9]["response_time_ms"] == 7
    assert all(strip[i]["response_time_ms"] is None for i in (10, 11, 12))
    assert strip[13]["level"] == "5" and strip[13]["service"] == '{"x":1}'
    assert strip[14]["level"] is None


def test_round_trip_and_payload_size(spark):
    logs = load_logs(spark, SF_SMALL)
    wire = wire_records(logs, keep=["event_id"])
    back = parse_logs(wire, keep=["event_id"]).select("event_id", *LOG_COLUMNS)
    assert back.exceptAll(logs.select("event_id", *LOG_COLUMNS)).count() == 0
    assert logs.select("event_id", *LOG_COLUMNS).exceptAll(back).count() == 0
    rows = logs.select(*LOG_COLUMNS, payload_bytes(LOG_COLUMNS).alias("n")).limit(200).collect()
    for r in rows:
        d = {k: v for k, v in r.asDict().items() if k != "n" and v is not None}
        assert len(json.dumps(d).encode()) == r["n"]


def test_narrow_schema_and_encode(spark):
    assert [f.name for f in log_schema(["level", "service"]).fields] == ["level", "service"]
    df = spark.createDataFrame([Row(level="INFO", service=None, ts=None)], "level string, service string, ts timestamp_ntz")
    enc = encode_logs(df, columns=["level", "service"], timestamp_col="ts").collect()[0]
    assert bytes(enc["value"]).decode() == '{"level":"INFO"}'  # null fields dropped


def test_long_ids_are_kept_whole(spark):
    ids = [5, 99_999_999, 1_234_567_891, 1_234_567_892]
    ev = spark.createDataFrame([(i, dt.datetime(2024, 1, 1), 1, "view", 2.0, '{"k": 1}') for i in ids],
                               "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    got = [r.request_id for r in logs_from_events(ev).orderBy("event_id").collect()]
    assert got == ["req-00000005", "req-99999999", "req-1234567891", "req-1234567892"]


def test_bad_timestamps_become_null_and_are_counted(spark):
    t = dt.datetime(2024, 1, 1, 12)
    stamps = ["bad", "", None, "2024-13-01T00:00:00Z", "2024-01-01T11:59:59Z", "2024-01-01T11:59:59.500000Z", "2024-01-01T18:59:59.500000+07:00", "2024-01-01T11:59:59.500Z"]
    wire = spark.createDataFrame([(f'{{"service":"a"{"" if s is None else f", \"timestamp\": \"{s}\""}}}'.encode(), t) for s in stamps], "value binary, timestamp timestamp_ntz")
    parsed = parse_logs(wire, columns=["timestamp", "service"])
    got = [r.event_ts for r in with_event_time(parsed).collect()]
    half = dt.datetime(2024, 1, 1, 11, 59, 59, 500_000)
    assert got == [None, None, None, None, half.replace(microsecond=0), half, half, half]
    r = ingest_delay(parsed).first()
    assert (r.samples, r.unparsed, r.max_delay_ms) == (4, 4, 1000.0)
    stream = [x.event_time for x in with_event_instant(parsed).select(F.unix_micros("event_time").alias("event_time")).collect()]
    assert [x is None for x in stream] == [x is None for x in got]
