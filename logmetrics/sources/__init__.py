"""Sources and sinks: table loading, the fixture log view, the wire codec, stream
readers, synthetic producers and the raw-log archive."""

from logmetrics.sources.codec import encode_logs, parse_logs, wire_records  # noqa: F401
from logmetrics.sources.fixtures import load_logs, logs_from_events, read_table  # noqa: F401
