"""Streaming = batch, restart adds nothing, replayed batches are idempotent, empty
batches keep the snapshot, admission control bounds batch size."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logmetrics import session
from logmetrics.config import ORIGINAL_SOURCE

from logmetrics.operators import series as S
from logmetrics.operators.windows import windowed_metrics
from logmetrics.plans.catalog import replay_stream
from logmetrics.session import ensure_checkpoint_dir, scratch_path
from logmetrics.sources import versions as V
from logmetrics.sources.archive import retention_tiers, split_retention
from logmetrics.sources.codec import parse_logs
from logmetrics.sources.fixtures import load_logs
from logmetrics.sources.streams import kafka_options, read_log_stream, topic_writer
from logmetrics.streaming import job as J
from logmetrics.streaming import run
from logmetrics.streaming import stateful as ST

from conftest import SF_SMALL

AVAILABLE_NOW = {"availableNow": True}


def _batch_counts(spark):
    return {(r.service, r.level): r["count"] for r in load_logs(spark, SF_SMALL).groupBy("service", "level").count().collect()}


def test_metrics_job_equals_batch_and_restart(spark):
    start = lambda s, root: J.start_metrics_job(s, f"{root}/h", f"{root}/c", trigger=AVAILABLE_NOW)
    root = replay_stream(spark, SF_SMALL, "t-job", start)
    hist = J.read_history(spark, f"{root}/h")
    per = S.select_series(hist, metric="spark_logs_per_batch").groupBy("service", "level").agg(F.sum("value").alias("n"))
    assert {(r.service, r.level): int(r.n) for r in per.collect()} == _batch_counts(spark)
    before = sorted(map(tuple, hist.collect()), key=repr)
    # restart from the checkpoint: nothing new to read, nothing new written
    start(read_log_stream(spark, "parquet", f"{root}/wire"), root).awaitTermination()
    assert sorted(map(tuple, J.read_history(spark, f"{root}/h").collect()), key=repr) == before
    # compaction changes the files, not the rows; the version before it reads the same
    version = V.newest(spark, f"{root}/h")
    after = J.compact_history(spark, f"{root}/h")
    assert J.compact_history(spark, f"{root}/h").number == after.number
    for number in (None, version.number):
        rows = J.read_history(spark, f"{root}/h", number)
        assert sorted(map(tuple, rows.collect()), key=repr) == before
    newest = sorted((r for r in before if r[0] == max(r[0] for r in before)), key=repr)
    assert sorted(map(tuple, J.latest_snapshot(spark, f"{root}/h").collect()), key=repr) == [r[:-1] for r in newest]


def _arrived(spark, shift="INTERVAL '0' DAY"):
    return load_logs(spark, SF_SMALL).select("service", "level", "response_time_ms", F.expr(f"event_ts + {shift}").alias("kafka_timestamp"))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replayed_and_empty_batches(spark):
    path = scratch_path(spark, "t-hist")
    J.create_history(spark, path)
    assert J.read_history(spark, path).count() == 0  # readable before the first batch
    logs = _arrived(spark)
    J.history_writer(path)(logs, 3)
    first = _rows(J.read_history(spark, path))
    J.history_writer(path)(logs, 3)  # retried batch, by a writer that has restarted
    assert _rows(J.read_history(spark, path)) == first
    J.history_writer(path)(logs.limit(0), 4)  # empty batch commits nothing; the snapshot stays batch 3
    hist = J.read_history(spark, path)
    assert hist.count() == len(first)
    assert {r.batch_id for r in S.latest_batch(hist).select("batch_id").distinct().collect()} == {3}
    assert {r.batch_id for r in J.latest_snapshot(spark, path).collect()} == {3}
    assert dict(hist.dtypes)["batch_id"] == "bigint"
    J.history_writer(path, "another")(logs, 0)  # a stream with its own checkpoint counts from 0
    assert J.read_history(spark, path).count() == 2 * len(first)


def test_history_keeps_late_batches_of_compacted_dates(spark):
    path = scratch_path(spark, "t-late")
    write = J.history_writer(path, compact_at=4)  # compacts by itself at the fourth folder
    for k, days in enumerate((0, 1, 0, 2)):
        write(_arrived(spark, f"INTERVAL '{days}' DAY"), k)
    assert len(V.newest(spark, path).of(J.TABLE)) == 3  # two dates, and the newest batch
    write(_arrived(spark), 4)  # late: its date is compacted
    hist = J.read_history(spark, path)
    assert {r.batch_id for r in hist.select("batch_id").distinct().collect()} == {0, 1, 2, 3, 4}
    before = _rows(hist)
    J.compact_history(spark, path)
    J.compact_history(spark, path)
    assert _rows(J.read_history(spark, path)) == before
    # a time range reads the folders that reach into it
    low, high = hist.where("batch_id = 1").agg(F.min("ts"), F.max("ts")).first()
    part = J.read_history(spark, path, start=low, stop=high)
    assert _rows(part) == _rows(hist.where("batch_id = 1")) and len(part.inputFiles()) < len(hist.inputFiles())


def test_a_micro_batch_is_scanned_once(spark):
    plan = J.batch_samples(_arrived(spark), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Subquery" not in plan


def test_batch_that_dies_before_its_commit(spark, monkeypatch):
    path = scratch_path(spark, "t-die")
    J.history_writer(path)(_arrived(spark), 0)
    before = _rows(J.read_history(spark, path))

    def dies(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(V, "commit", dies)
        with pytest.raises(RuntimeError, match="killed"):
            J.history_writer(path)(_arrived(spark, "INTERVAL '1' DAY"), 1)
    assert _rows(J.read_history(spark, path)) == before
    J.history_writer(path)(_arrived(spark, "INTERVAL '1' DAY"), 1)
    assert J.read_history(spark, path).count() == 2 * len(before)


def test_stateful_count_and_watermark_windows(spark):
    def total(stream, root):
        return ST.start_changes_sink(ST.logs_total(parse_logs(stream, columns=["service", "level"])), f"{root}/t", f"{root}/c", AVAILABLE_NOW)

    root = replay_stream(spark, SF_SMALL, "t-state", total)
    schema = ST.logs_total(load_logs(spark, SF_SMALL)).schema
    got = {(r.service, r.level): r.logs_total for r in ST.read_changes(spark, f"{root}/t", schema).collect()}
    assert got == _batch_counts(spark)

    def windows(stream, root):
        parsed = parse_logs(stream, columns=["timestamp", "service", "level", "response_time_ms"])
        return ST.start_append_sink(ST.windowed_stream(parsed, "1 minute", "1 minute"), f"{root}/w", f"{root}/c", trigger=AVAILABLE_NOW)

    out = spark.read.parquet(f"{replay_stream(spark, SF_SMALL, 't-window', windows)}/w")
    logs = load_logs(spark, SF_SMALL)
    wm = logs.agg(F.max("event_ts")).collect()[0][0]
    batch = windowed_metrics(logs, "1 minute").filter(F.col("window_end") <= F.lit(wm - dt.timedelta(minutes=1)))
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_kafka_options():
    o = kafka_options("k1:9092,k2:9092")
    assert o == {"kafka.bootstrap.servers": "k1:9092,k2:9092", "subscribe": "application-logs",
                 "startingOffsets": "latest", "failOnDataLoss": "true"}
    o = kafka_options("k1:9092", **ORIGINAL_SOURCE)
    assert (o["failOnDataLoss"], o["maxOffsetsPerTrigger"]) == ("false", "10000")


def test_topic_sink_options():
    class Writer:
        def __init__(self):
            self.set = {}

        def format(self, f):
            self.set["format"] = f
            return self

        def option(self, k, v):
            self.set[k] = v
            return self

    w = topic_writer(Writer(), "k:9092", "t", "/ckpt").set
    assert w == {"format": "kafka", "kafka.bootstrap.servers": "k:9092", "topic": "t", "checkpointLocation": "/ckpt"}


def test_job_arguments(monkeypatch):
    a = run.arguments(["--bootstrap-servers", "b:1", "--history", "h", "--checkpoint", "c"])
    assert (a.topic, a.trigger, a.max_offsets_per_trigger, a.skip_lost_offsets) == ("application-logs", "1 second", None, False)
    for k, v in {"BOOTSTRAP_SERVERS": "e:2", "HISTORY": "x", "CHECKPOINT": "y", "TRIGGER": "5 seconds"}.items():
        monkeypatch.setenv(k, v)
    a = run.arguments([])
    assert (a.bootstrap_servers, a.history, a.checkpoint, a.trigger) == ("e:2", "x", "y", "5 seconds")


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_archive_stream_and_scan(spark):
    from logmetrics.config import LOG_COLUMNS
    from logmetrics.sources.archive import scan_archive

    def start(stream, root):
        return ST.start_append_sink(ST.archive_stream(parse_logs(stream)), f"{root}/a", f"{root}/c", partition_by=["date"], trigger=AVAILABLE_NOW)

    root = replay_stream(spark, SF_SMALL, "t-archive", start)
    back = scan_archive(spark, f"{root}/a").select(*LOG_COLUMNS)
    logs = load_logs(spark, SF_SMALL).select(*LOG_COLUMNS)
    assert back.exceptAll(logs).count() == 0 and logs.exceptAll(back).count() == 0
    one_day = scan_archive(spark, f"{root}/a", "2024-01-05", "2024-01-05")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    pf = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "date" in pf and "2024-01-05" in pf  # the date range prunes folders
    assert one_day.count() == logs.filter(F.col("timestamp").startswith("2024-01-05")).count()


def test_archive_writes_are_repeatable_and_retention_is_exact(spark):
    t = dt.datetime(2024, 3, 1, 12)
    ages = [dt.timedelta(days=6, hours=23), dt.timedelta(days=7), dt.timedelta(days=7, microseconds=1), dt.timedelta(days=30), dt.timedelta(days=31)]
    logs = spark.createDataFrame([(i, t - a) for i, a in enumerate(ages)], "i int, event_ts timestamp_ntz")
    tiers = {r.i: r.tier for r in retention_tiers(logs, as_of=t).collect()}
    assert tiers == {0: "topic", 1: "topic", 2: "hot", 3: "hot", 4: "archive"}
    root = scratch_path(spark, "t-ret")
    for _ in range(2):
        split_retention(logs, f"{root}/hot", f"{root}/archive", as_of=t)
    assert spark.read.parquet(f"{root}/hot").count() == 4 and spark.read.parquet(f"{root}/archive").count() == 1


def test_scratch_is_dropped(spark):
    path = scratch_path(spark, "t-gone")
    spark.range(3).write.parquet(path)
    kept, session._scratch[:] = list(session._scratch), [path]
    session.drop_scratch()
    session._scratch[:] = kept
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
