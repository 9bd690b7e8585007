"""Helpers shared by the operators: table access, stored intermediates, and an Arrow
scan that adds columns to a table from its text column."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logmetrics.session import materialize

#: Bytes of text that one call of a scan function gets, beyond a single longer text.
SLICE_BYTES = 4 << 20

Field = tuple[str, str, pa.DataType]  # column name, Spark type, Arrow type


#: Rows of an Arrow batch: some megabytes of texts of usual length.
ROWS_AT_ONCE = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would,
    so that tasks can import it wherever the driver was started; and, unless the session
    has its own setting, bound the rows of a batch that go to a task's Python at once,
    since a row here is a whole text."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    if spark.conf.get(_BATCH_ROWS) == "10000":  # Spark's default suits short rows
        spark.conf.set(_BATCH_ROWS, str(ROWS_AT_ONCE))
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="logmetrics-")  # only the driver reads it, to serve it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/logmetrics.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "logmetrics").rglob("*.py")):
            z.write(f, f.relative_to(root).as_posix())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: later steps re-read a small
    table instead of recomputing, also after an executor is lost."""
    ship(df.sparkSession)
    return materialize(df, f"llm-{name}")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(key, n: int):
    """crc32 of the key as text, modulo ``n``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (one row at least) that cover all rows."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def split_text(text: bytes, most: int) -> Iterator[bytes]:
    """A long text in parts of about ``most`` bytes, cut after white space only, so that
    no word is cut; a longer word stays whole."""
    at = 0
    while len(text) - at > most:
        cut = max(text.rfind(b" ", at, at + most), text.rfind(b"\n", at, at + most))
        if cut < 0:
            ahead = [x for x in (text.find(b" ", at + most), text.find(b"\n", at + most)) if x >= 0]
            if not ahead:
                break
            cut = min(ahead)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def add_from_text(
    df: DataFrame,
    fields: Sequence[Field],
    make: Callable[[], Callable[[list], Sequence[Sequence]]],
    text: str = "text",
    as_bytes: bool = False,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """All columns of ``df`` plus ``fields``, computed from the column ``text``.  A field
    whose name ``df`` has already gets underscores added, here and in all operators.

    ``make()`` runs once per task and returns a function from a list of texts (None for
    null; UTF-8 bytes with ``as_bytes``) to one list of values per field."""
    ship(df.sparkSession)
    schema = T.StructType(list(df.schema.fields))
    for name, kind, _ in fields:
        schema = schema.add(fresh(df, name), T.DataType.fromDDL(kind))
    at = df.columns.index(text)
    kinds = [k for _, _, k in fields]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            column = batch.column(at)
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, slice_bytes):
                part = batch.slice(a, b - a)
                col = part.column(at)
                values = (col.cast(pa.binary()) if as_bytes else col).to_pylist()
                new = [v if isinstance(v, pa.Array) else pa.array(v, type=k) for v, k in zip(work(values), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return df.mapInArrow(scan, schema)
