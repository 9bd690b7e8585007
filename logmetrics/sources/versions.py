"""Tables that change by commits: a numbered manifest names the folders each table
consists of, so readers see one version, and several tables change at once.

A writer first writes whole folders of parquet, which nobody reads yet, and then commits:
the next manifest (one small JSON file, which Spark's committer makes visible by one
rename) lists what was there, less what is removed, plus what is added.  A run that dies
before its commit leaves folders that no manifest names; a run that is repeated finds its
``done`` mark and adds nothing.  Manifests name folders with their date and time range,
so a reader of a range, or of the newest folder, lists nothing else.

Manifests stay small by compaction of what they name; ``vacuum`` removes old ones and the
folders only they name.  Two writers that start from one version get different numbers or
an error from the write of the second, who then starts over from the newest."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass

from pyarrow.fs import FileSystem, FileType
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ENTRY = "tab string, path string, date date, low timestamp_ntz, high timestamp_ntz, rows bigint, added bigint, writer string, done bigint"
_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}  # the default drops microseconds
KEPT = 20


@dataclass(frozen=True)
class Entry:
    """A folder of a table, with the date, the time range and the rows it holds and the
    version that added it; or, with a ``writer``, the newest work of that writer that is
    done."""

    tab: str | None = None
    path: str | None = None
    date: dt.date | None = None
    low: dt.datetime | None = None
    high: dt.datetime | None = None
    rows: int | None = None
    added: int | None = None
    writer: str | None = None
    done: int | None = None


@dataclass(frozen=True)
class Version:
    number: int
    entries: tuple[Entry, ...] = ()

    def of(self, tab: str) -> list[Entry]:
        """The folders of a table, oldest commit first."""
        return sorted((e for e in self.entries if e.tab == tab), key=lambda e: (e.added, e.path))

    def done(self, writer: str) -> int:
        """The newest work of ``writer`` that is committed; -1 before the first."""
        return max((e.done for e in self.entries if e.writer == writer), default=-1)


Change = tuple[Iterable[Entry], Iterable[Entry]]  # added, removed


def _manifests(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{_ENTRY}, v bigint").options(**_TIME).json(f"{root}/manifests")


def newest(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version, or that of a ``number`` that is still kept."""
    try:
        rows = _manifests(spark, root)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return Version(0)
    if number is None:
        number = rows.agg(F.max("v")).first()[0]
        if number is None:
            return Version(0)
    found = [r.asDict() for r in rows.where(F.col("v") == number).collect()]  # one manifest
    if not found:
        raise ValueError(f"version {number} is not kept")
    for r in found:
        r.pop("v")
    return Version(number, tuple(e for e in (Entry(**r) for r in found) if e.tab or e.writer))


def commit(spark: SparkSession, root: str, change: Callable[[Version], Change | None], writer: str | None = None, work: int | None = None,
           base: Version | None = None) -> Version:
    """Make the next version by ``change`` of the newest, again if another writer was first.

    ``change`` returns the folders to add and to remove, or None for no commit.  With
    ``writer`` and ``work`` (rising numbers), work that is done already is not repeated.
    ``base`` is the newest version as far as the writer knows."""
    base = base or newest(spark, root)
    number = base.number + 1
    while True:
        if writer is not None and base.done(writer) >= work:
            return base
        made = change(base)
        if made is None:
            return base
        add, remove = ({e.path: e for e in es} for es in made)
        if missing := remove.keys() - {e.path for e in base.entries}:
            raise ValueError(f"not in version {base.number}: {sorted(missing)}")
        kept = [e for e in base.entries if e.path not in remove and (e.writer is None or e.writer != writer)]
        kept += [Entry(**{**asdict(e), "added": number if e.added is None else e.added}) for e in add.values()]
        if writer is not None:
            kept.append(Entry(writer=writer, done=work))
        rows = [tuple(asdict(e).values()) for e in [Entry(), *kept]]  # the first row marks an empty version
        try:
            spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("error").options(**_TIME).json(f"{root}/manifests/v={number:012d}")
            return Version(number, tuple(kept))
        except AnalysisException as e:
            if "PATH_ALREADY_EXISTS" not in str(e):
                raise
        now = newest(spark, root)
        # A number without a readable manifest is of a writer that died: it is passed over.
        number = now.number + 1 if now.number > base.number else number + 1
        base = now


def new_folder(root: str, tab: str) -> str:
    return f"{root}/{tab}/{uuid.uuid4().hex}"


def write_folder(rows: DataFrame, root: str, tab: str, time_col: str) -> Entry:
    """Write ``rows`` as one new folder, whose entry has their count and time range; they
    come from the written files."""
    path = new_folder(root, tab)
    rows.write.parquet(path)
    low, high, n = rows.sparkSession.read.schema(rows.schema).parquet(path).agg(F.min(time_col), F.max(time_col), F.count("*")).first()
    return Entry(tab=tab, path=path, date=low.date() if low and low.date() == high.date() else None, low=low, high=high, rows=n)


def write_dates(rows: DataFrame, root: str, tab: str, time_col: str) -> list[Entry]:
    """Write ``rows`` as one new folder per date of ``time_col``, an entry each.

    Rows are range-partitioned on time first: a task writes a contiguous slice, so files
    are few, and a date with a third of all rows is split over many tasks."""
    path = new_folder(root, tab)
    part = "date_of_row"
    dated = rows.withColumn(part, F.to_date(time_col))
    dated.repartitionByRange(F.col(time_col)).write.partitionBy(part).parquet(path)
    try:
        written = rows.sparkSession.read.schema(dated.schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    stats = written.groupBy(part).agg(F.min(time_col), F.max(time_col), F.count("*")).collect()  # a row per date
    null = "__HIVE_DEFAULT_PARTITION__"
    return [Entry(tab=tab, path=f"{path}/{part}={day or null}", date=day, low=low, high=high, rows=n) for day, low, high, n in stats]


def read(spark: SparkSession, entries: Sequence[Entry], schema: StructType | str) -> DataFrame:
    """The rows of some folders."""
    if not entries:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[e.path for e in entries])


def compact(spark: SparkSession, root: str, tab: str, schema: StructType | str, time_col: str, spare: int = 0) -> Version:
    """Dates of several folders become one folder each, by one parallel write and one
    commit; the newest ``spare`` folders stay."""

    def merge(base: Version) -> Change | None:
        entries = base.of(tab)
        old = entries[: len(entries) - spare]
        several = {e.date for e in old if sum(o.date == e.date for o in old) > 1 or e.date is None and e.rows and e.low != e.high}
        many = [e for e in old if e.date in several]
        return (write_dates(read(spark, many, schema), root, tab, time_col), many) if many else None

    return commit(spark, root, merge)


def delete_folder(path: str) -> None:
    fs, place = FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    if fs.get_file_info(place).type == FileType.Directory:
        fs.delete_dir(place)


def vacuum(spark: SparkSession, root: str, keep: int = KEPT) -> list[str]:
    """Remove all but the newest ``keep`` manifests, and the folders only they name.  Readers
    of an older version must be done.  Folders of runs that never committed stay."""
    rows = _manifests(spark, root)
    numbers = sorted(r.v for r in rows.select("v").distinct().collect())
    old, kept = numbers[:-keep], numbers[-keep:]
    if not old:
        return []
    paths = rows.where(F.col("path").isNotNull()).select("path", F.col("v").isin(kept).alias("live"))
    gone = [r.path for r in paths.groupBy("path").agg(F.max("live").alias("live")).where(~F.col("live")).collect()]
    for path in (*gone, *(f"{root}/manifests/v={v:012d}" for v in old)):
        delete_folder(path)
    return gone
