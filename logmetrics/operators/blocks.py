"""An ordered per-series computation that never puts a whole series in one task.

A window ``PARTITION BY series ORDER BY ts`` sends every row of a series to one task,
so one hot series would become one huge task.  ``blocked_lead`` splits each series into
time blocks (``PARTITION BY series, block``).  The first value of the next block comes
from a small per-block table (one row per series and block) and enters the block as one
extra *carry* row that sorts after the block's own rows and is dropped afterwards, so
the large side is shuffled exactly once (for the window) and never joined.  With no
series columns, all rows are one series, whose block table is ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logmetrics.functions.time import epoch_micros, interval_micros

BLOCK = "1 day"


def with_block(df: DataFrame, ts_col: str, block: str | int = BLOCK, out: str = "_blk") -> DataFrame:
    b = interval_micros(block)
    us = epoch_micros(ts_col)
    return df.withColumn(out, us - F.pmod(us, F.lit(b)))


def _series_window(keys: Sequence[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _with_carry(d: DataFrame, carry: DataFrame, keys: Sequence[str], ts_col: str, value_col: str) -> DataFrame:
    """Union the data rows (``_carry_row`` false) with carry rows ``(keys, _blk, _c)``."""
    c = carry.select(*keys, "_blk", F.col("_c").cast(d.schema[value_col].dataType).alias(value_col),
                     F.lit(True).alias("_carry_row"))
    return d.withColumn("_carry_row", F.lit(False)).unionByName(c, allowMissingColumns=True)


def blocked_lead(df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str, out: str,
                 block: str | int = BLOCK) -> DataFrame:
    """``out`` = ``value_col`` of the next row of the series (null for the last)."""
    keys = list(keys)
    d = with_block(df, ts_col, block)
    firsts = d.groupBy(*keys, "_blk").agg(F.min_by(value_col, ts_col).alias("_first"))
    carry = firsts.select(*keys, "_blk", F.lead("_first").over(_series_window(keys).orderBy("_blk")).alias("_c"))
    u = _with_carry(d, carry, keys, ts_col, value_col)
    w = Window.partitionBy(*keys, "_blk").orderBy(F.col("_carry_row").asc(), F.col(ts_col))
    return u.withColumn(out, F.lead(value_col).over(w)).filter(~F.col("_carry_row")).drop("_carry_row", "_blk")
