import math

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL


def test_entry_and_contract(spark):
    out = E.entry(spark)
    assert out.count() > 0
    assert {"service", "level", "log_count", "p95"} <= set(out.columns)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["batch_metrics", "error_rate", "window_5m", "metrics_history", "series_reduce", "total_logs",
                                  "ingest_delay", "retention_split", "stream_batch_metrics"])
def test_oracle_small(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    key = lambda r: tuple(repr(v) for v in r if not isinstance(v, float))
    want = sorted(res.fetchall(), key=key)
    got = sorted(map(tuple, E.queries()[name](spark, SF_SMALL).select(*cols).collect()), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            assert a == b or isinstance(a, float) and math.isclose(a, b, rel_tol=1e-9), (g, w)


@pytest.mark.parametrize("name", ["counter_samples_series", "counter_increase_series", "counter_rate_series"])
def test_counters_per_series(spark, name, tmp_path):
    """Every step of every (service, level) series, as the SQL has them."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    con.execute(f"CREATE TABLE want AS {E.oracle_sql()[name]}")
    cols = [r[0] for r in con.execute("DESCRIBE want").fetchall()]
    E.queries()[name](spark, SF_SMALL).select(*cols).write.parquet(f"{tmp_path}/got")
    near = " AND ".join(f"abs(w.{c} - g.{c}) <= 1e-9 * abs(w.{c})" for c in cols[3:])
    same = f"SELECT count(*) FROM want w JOIN '{tmp_path}/got/*.parquet' g USING (service, level, ts) WHERE {near}"
    rows, series = con.execute("SELECT count(*), count(DISTINCT (service, level)) FROM want").fetchone()
    assert cols[:3] == ["service", "level", "ts"] and series > 6
    assert con.execute(same).fetchone()[0] == rows == con.execute(f"SELECT count(*) FROM '{tmp_path}/got/*.parquet'").fetchone()[0]


def test_no_simulator_is_registered():
    assert not [q for q in E.queries() if q.startswith("synth")]


def test_stream_batch_metrics_has_a_batch_for_every_week(spark, tmp_path):
    """However many weeks there are, also with gaps, before 2000 and around records without a time."""
    days = ["1999-12-28", "2024-01-01", "2024-01-07", "2024-01-08", "2024-01-16", "2024-01-24", "2024-02-14", "2024-02-14"]
    rows = [f"({i}, TIMESTAMP '{d} 10:00:{i}.25', {i % 2}, '{('view', 'error')[i % 3 == 0]}', {i * 10.5}, '{{\"k\": {i}}}')" for i, d in enumerate(days)]
    rows += [rows[3], "(90, NULL, 1, 'error', 5.0, NULL)", "(NULL, TIMESTAMP '2024-01-08 11:00:00', 1, NULL, NULL, NULL)"]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    con.execute(f"INSERT INTO events VALUES {', '.join(rows)}")
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    out = E.queries()["stream_batch_metrics"](spark, str(tmp_path))
    got = sorted(map(tuple, out.collect()), key=repr)
    counted = {}
    for r in got:
        if r[2] == "spark_logs_per_batch":
            counted[r[0]] = counted.get(r[0], 0) + r[6]
    assert counted == {0: 2, 1: 2, 2: 3, 3: 1, 4: 1, 5: 2}  # the record without a time is in the first
    sql = f"SELECT {', '.join(out.columns)} FROM ({E.oracle_sql()['stream_batch_metrics']}) s"
    assert got == sorted(con.execute(sql).fetchall(), key=repr)
