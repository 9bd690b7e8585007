"""Fixed values shared by the whole package.

The values in the block marked FIXED VALUES must equal the ones the application's
producers, streaming job and dashboards use; results depend on them.
"""

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the application's; do not reorder)
# ---------------------------------------------------------------------------

# Log record fields, in wire order: (name, spark type).
LOG_FIELDS = [
    ("timestamp", StringType()),
    ("level", StringType()),
    ("service", StringType()),
    ("host", StringType()),
    ("request_id", StringType()),
    ("trace_id", StringType()),
    ("http_method", StringType()),
    ("http_path", StringType()),
    ("http_status", IntegerType()),
    ("response_time_ms", IntegerType()),
    ("client_ip", StringType()),
    ("message", StringType()),
    ("stack_trace", StringType()),
]

LEVELS = ["DEBUG", "INFO", "WARN", "ERROR"]
ERROR_LEVEL = "ERROR"

# What the web producer writes.
WEB_SERVICES = [
    "api-gateway",
    "auth-service",
    "user-service",
    "payment-service",
    "order-service",
    "notification-service",
]
WEB_METHODS = ["GET", "POST", "PUT", "DELETE", "PATCH"]
WEB_PATHS = [
    "/api/v1/users",
    "/api/v1/orders",
    "/api/v1/payments",
    "/api/v1/products",
    "/api/v1/auth/login",
    "/api/v1/auth/logout",
    "/api/v1/notifications",
    "/api/v1/health",
    "/api/v1/metrics",
]
WEB_MESSAGE = "Load test log"

# Histogram bucket upper bounds (the +Inf bucket is implicit).
SIZE_BUCKETS = [100.0, 200.0, 500.0, 1000.0, 2000.0, 5000.0]
LATENCY_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]

# Dashboard threshold steps: (lower bound, band); the first band has no bound.
THRESHOLDS = {
    "logs_per_second": [(None, "green"), (500.0, "yellow"), (1000.0, "red")],
    "error_rate_pct": [(None, "green"), (5.0, "yellow"), (10.0, "red")],
    "latency_ms": [(None, "green"), (200.0, "yellow"), (500.0, "red")],
}

# Gauge names written by the streaming job.
METRIC_LOGS_PER_BATCH = "spark_logs_per_batch"
METRIC_ERROR_RATE = "spark_error_rate"
METRIC_LATENCY = "spark_latency_ms"
PERCENTILES = [("p50", 0.5), ("p95", 0.95), ("p99", 0.99)]

# Source defaults of the streaming job.
DEFAULT_TOPIC = "application-logs"
ORIGINAL_SOURCE = {"fail_on_data_loss": False, "max_offsets_per_trigger": 10000}
DEFAULT_TRIGGER = "1 second"
DEFAULT_QUERY_NAME = "unified_metrics"

# Dashboard defaults.
DASHBOARD_RANGE = "15 minutes"
DEFAULT_LOOKBACK = "5 minutes"
SCRAPE_INTERVAL = "15 seconds"

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

LOG_SCHEMA = StructType([StructField(n, t, True) for n, t in LOG_FIELDS])
LOG_COLUMNS = [n for n, _ in LOG_FIELDS]

# Library default for percentile_approx (Spark's own default accuracy).
DEFAULT_ACCURACY = 10000
# Default anomaly threshold (% errors): the dashboard's red band for error rate.
DEFAULT_ANOMALY_THRESHOLD = 10.0
# Default watermark delay for event-time windows in streaming.
DEFAULT_WATERMARK = "1 minute"
