"""Daily report per (date, service, level): volume, errors, latency and status mix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logmetrics.config import DEFAULT_ACCURACY
from logmetrics.operators.metrics import is_error, percentile_columns

STATUS_CLASSES = (2, 3, 4, 5)


def daily_report(logs: DataFrame, keys: Sequence[str] = ("service", "level"), time_col: str = "event_ts",
                 accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    status_class = F.floor(F.col("http_status") / F.lit(100))
    agg = logs.groupBy(F.to_date(F.col(time_col)).alias("date"), *keys).agg(
        F.count(F.lit(1)).alias("log_count"),
        F.count_if(is_error()).alias("error_count"),
        F.avg("response_time_ms").alias("avg_latency"),
        *percentile_columns("response_time_ms", accuracy, exact),
        *[F.count_if(status_class == F.lit(k)).alias(f"status_{k}xx") for k in STATUS_CLASSES],
    )
    return agg.withColumn(
        "error_rate", F.try_divide(F.col("error_count").cast("double"), F.col("log_count")) * F.lit(100.0)
    )
