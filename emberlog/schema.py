"""Field lists, types and thresholds of the log data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire fields, levels, thresholds and defaults of the log contract.
REQUIRED_STRINGS = ("timestamp", "log_level", "service_name", "endpoint", "user_id", "ip_address", "message")
REQUIRED_FIELDS = (
    ("timestamp", "string"),
    ("log_level", "string"),
    ("service_name", "string"),
    ("endpoint", "string"),
    ("response_time_ms", "int"),
    ("status_code", "int"),
    ("user_id", "string"),
    ("ip_address", "string"),
    ("message", "string"),
)
OPTIONAL_FIELDS = (
    ("request_id", "string"),
    ("region", "string"),
    ("environment", "string"),
    ("host", "string"),
    ("version", "string"),
    ("retry_count", "int"),
    ("error_code", "string"),
    ("stack_trace", "string"),
    ("threshold_ms", "int"),
    ("queue_depth", "int"),
)
LEVELS = ("INFO", "WARN", "ERROR", "CRITICAL")
ERROR_LEVELS = ("ERROR", "CRITICAL")
SLOW_MS = 1000
API_FIELDS = (
    "timestamp", "log_level", "service_name", "endpoint", "response_time_ms", "status_code", "user_id",
    "ip_address", "message", "request_id", "region", "environment", "is_error", "is_slow", "level_int",
    "hour_of_day",
)
INTERNAL_FIELDS = ("parsed_timestamp", "consumed_at", "features")
MODEL_FEATURES = (
    "response_time_ms", "response_time_zscore", "is_error", "log_level_int", "error_rate_5min",
    "avg_response_5min", "request_count_per_ip",
)
LEGACY_FEATURES = (
    "response_time_ms", "status_code", "log_level_int", "error_rate_5min", "avg_response_5min", "hour_of_day",
)
ROLLING_WINDOW_S = 300
WARM_UP_ROWS = 100
COLD_START_ERROR_RATE = 0.05
COLD_START_AVG_RESPONSE = 150.0
LEGACY_ERROR_RATE = 0.0
LEGACY_AVG_RESPONSE = 200.0
DEFAULT_RT_MEAN = 792.96
DEFAULT_RT_STD = 2101.42
RECENT_ROWS = 1000
RECENT_LOGS_KEPT = 500
ALERTS_KEPT = 100
ALERT_WINDOW_S = 60
ALERT_HIGH = 10
ALERT_CRITICAL = 25
ALERT_COOLDOWN_S = 30
NOTICE_PERIOD_S = 5
ALERT_TYPE = "HIGH_ANOMALY_RATE"
CONTAMINATION = 0.05
CONTAMINATION_SWEEP = (0.02, 0.05, 0.08, 0.10, 0.15)
TEST_FRACTION = 0.20

MICROS = 1_000_000

_SPARK_TYPES = {"string": T.StringType(), "int": T.IntegerType()}

HISTORY_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(n, _SPARK_TYPES[t]) for n, t in REQUIRED_FIELDS if n != "timestamp"]
    + [T.StructField(n, _SPARK_TYPES[t]) for n, t in OPTIONAL_FIELDS]
    + [
        T.StructField("level_int", T.IntegerType()),
        T.StructField("is_error", T.BooleanType()),
        T.StructField("is_slow", T.BooleanType()),
        T.StructField("status_class", T.IntegerType()),
        T.StructField("is_server_error", T.BooleanType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("endpoint_depth", T.IntegerType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("anomaly_score", T.DoubleType()),
    ]
)

TRAINING_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("log_level", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("response_time_ms", T.StringType()),
        T.StructField("status_code", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("environment", T.StringType()),
    ]
)
TRAINING_REQUIRED = ("log_level", "response_time_ms", "status_code", "ip_address")

SAMPLE_LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("log_level", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("response_time_ms", T.IntegerType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("anomaly_count", T.IntegerType()),
        T.StructField("window_seconds", T.IntegerType()),
        T.StructField("rate_per_min", T.DoubleType()),
        T.StructField("threshold_used", T.IntegerType()),
        T.StructField("sample_log", SAMPLE_LOG_SCHEMA),
    ]
)
