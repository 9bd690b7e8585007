"""Threshold bands: map a value to the dashboard colour band it falls in.

Steps are (lower bound, band) with inclusive lower bounds; the first band has none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logmetrics.config import THRESHOLDS


def band(value: Column, steps: Sequence[tuple[float | None, str]]) -> Column:
    expr = F.lit(steps[0][1])
    for bound, name in steps[1:]:
        expr = F.when(value >= F.lit(float(bound)), F.lit(name)).otherwise(expr)
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(expr)


def threshold_band(df: DataFrame, value_col: str, panel: str, out: str = "band") -> DataFrame:
    return df.withColumn(out, band(F.col(value_col), THRESHOLDS[panel]))
