"""Session helpers: build a session for tests and the bench, and find the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import SparkSession

_scratch: list[str] = []


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "logmetrics") -> SparkSession:
    """Local session used by tests and ``bench.py``.  On a cluster, use the session
    ``spark-submit`` gives you; nothing in the library depends on these settings except
    the UTC zone (only the wire-format parser looks at zone offsets)."""
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  A cluster names it in
    ``spark.checkpoint.dir``; only when it is unset (local tests) do we create one."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no SparkContext
        sc = None
    path = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="logmetrics-ckpt-", dir="/tmp")  # one machine, as in tests
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for tables a job writes to cut
    lineage or to hand data from one stage to the next."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def drop_scratch() -> None:
    """Delete all folders that ``scratch_path`` gave out in this process.  For the end of
    a job: tables read from them are gone then."""
    while _scratch:
        uri = re.sub(r"^file:/+", "file:///", _scratch.pop())
        fs, path = FileSystem.from_uri(uri)
        if fs.get_file_info(path).type == FileType.Directory:
            fs.delete_dir(path)


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used at the small boundaries of multi-stage plans (per-step counts, dense counter
    samples, metrics history): the upstream plan - often a full scan of the logs - runs
    once, later stages that read the table several times re-read a small stored table,
    and the lineage is cut, so a lost executor never recomputes from the raw logs."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
