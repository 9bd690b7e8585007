"""Column-level helpers (built-in Spark expressions only; no Python UDFs)."""

from logmetrics.functions.time import (  # noqa: F401
    add_micros,
    bucket_end,
    bucket_start,
    epoch_micros,
    interval_micros,
    iso_utc,
    parse_iso_utc,
)
from logmetrics.functions.text import payload_bytes, series_label, zero_padded  # noqa: F401
