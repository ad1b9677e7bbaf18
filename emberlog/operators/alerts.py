"""Sliding-window anomaly alerts with a cooldown per service."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import scalar as X
from emberlog.operators.ordered import trailing_totals
from emberlog.operators.parsing import sample_log
from emberlog.operators.throttle import throttle
from emberlog.schema import (
    ALERT_COOLDOWN_S,
    ALERT_CRITICAL,
    ALERT_HIGH,
    ALERT_TYPE,
    ALERT_WINDOW_S,
    MICROS,
    NOTICE_PERIOD_S,
)
from emberlog.session import stage


def anomaly_counts(
    anomalies: DataFrame, instant: str = "us", tie: str = "seq", scope: str = "global",
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add ``anomaly_count``: anomalies of the last 60 seconds, both ends inclusive, the row itself included."""
    if scope not in ("global", "service"):
        raise ValueError("scope must be global or service")
    keys = ("service_name",) if scope == "service" else ()
    return trailing_totals(
        anomalies, instant, tie, ALERT_WINDOW_S * MICROS, {"anomaly_count": F.lit(1).cast("bigint")}, keys,
        closed=True, rows_per_bucket=rows_per_bucket,
    )


def severity(count: Column) -> Column:
    return F.when(count > ALERT_CRITICAL, "CRITICAL").when(count > ALERT_HIGH, "HIGH")


def build_alerts(fired: DataFrame, instant: str = "us") -> DataFrame:
    """Alert records of the rows that fired. The id depends on service and instant, so replays repeat it."""
    count = F.col("anomaly_count")
    level = severity(count)
    return fired.select(
        F.concat(
            F.lit("alt-"),
            F.substring(F.md5(F.concat_ws("|", "service_name", F.lit(ALERT_TYPE), F.col(instant))), 1, 8),
        ).alias("alert_id"),
        X.iso_text(F.timestamp_micros(instant)).alias("timestamp"),
        F.lit(ALERT_TYPE).alias("alert_type"),
        level.alias("severity"),
        count.cast("int").alias("anomaly_count"),
        F.lit(ALERT_WINDOW_S).alias("window_seconds"),
        X.per_minute(count, ALERT_WINDOW_S).alias("rate_per_min"),
        F.when(level == "CRITICAL", ALERT_CRITICAL).otherwise(ALERT_HIGH).alias("threshold_used"),
        sample_log().alias("sample_log"),
    )


def fire_alerts(
    df: DataFrame, instant: str = "us", tie: str = "seq", scope: str = "global", rows_per_bucket: int | None = None
) -> DataFrame:
    """The anomaly rows that fire an alert, with their window count."""
    counted = anomaly_counts(df.filter("is_anomaly"), instant, tie, scope, rows_per_bucket)
    # Stored, because the throttle reads it twice and the count behind it is a shuffle of all anomalies.
    over = stage(counted.filter(F.col("anomaly_count") > ALERT_HIGH), "over")
    return throttle(over, ["service_name"], instant, tie, ALERT_COOLDOWN_S * MICROS, rows_per_bucket=rows_per_bucket)


def alerts(df: DataFrame, instant: str = "us", tie: str = "seq", scope: str = "global") -> DataFrame:
    return build_alerts(fire_alerts(df, instant, tie, scope), instant)


def notices(
    df: DataFrame, instant: str = "us", tie: str = "seq", rows_per_bucket: int | None = None
) -> DataFrame:
    """Anomaly rows shown at most once per five seconds for each service and level."""
    return throttle(
        df.filter("is_anomaly"), ["service_name", "log_level"], instant, tie, NOTICE_PERIOD_S * MICROS,
        rows_per_bucket=rows_per_bucket,
    )


def alert_counters(anomalies: DataFrame, alert_log: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """One row: anomalies of the current 60 seconds and their rate, anomalies in all, alerts fired."""
    start = F.unix_micros(X.instant(as_of)) - ALERT_WINDOW_S * MICROS
    current = F.count_if(F.unix_micros("timestamp") >= start)
    seen = anomalies.filter("is_anomaly").agg(
        current.alias("current_window_count"), F.count("*").alias("total_anomalies")
    )
    # One row each.
    fired = F.broadcast(alert_log.agg(F.count("*").alias("total_alerts_fired")))
    return seen.crossJoin(fired).select(
        "current_window_count", F.lit(ALERT_WINDOW_S).alias("window_seconds"),
        F.lit(ALERT_HIGH).alias("threshold_high"), F.lit(ALERT_CRITICAL).alias("threshold_critical"),
        "total_anomalies", "total_alerts_fired",
        X.per_minute(F.col("current_window_count"), ALERT_WINDOW_S).alias("alert_rate_current"),
    )
