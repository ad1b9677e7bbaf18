"""Filters, search and paging over the log table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions.scalar import instant
from emberlog.operators.parsing import parse_alerts, parse_recent
from emberlog.schema import LEVELS

MAX_PAGE = 500


@dataclass(frozen=True)
class Page:
    """One page of a search and the rows it was taken from."""

    matches: DataFrame
    rows: DataFrame

    def total(self) -> int:
        return self.matches.count()


def _bounded(name: str, value: int | None, low: int, high: int | None = None) -> None:
    if value is not None and (value < low or (high is not None and value > high)):
        raise ValueError(f"{name}={value} is outside {low}..{'' if high is None else high}")


def valid_level(level: str | None) -> str | None:
    if not level:
        return None
    if level.upper() not in LEVELS:
        raise ValueError(f"unknown level {level!r}, expected one of {', '.join(LEVELS)}")
    return level.upper()


def newest_first(df: DataFrame, n: int, offset: int = 0) -> DataFrame:
    """The newest rows by event time; a bounded top-N per task, no global sort."""
    ordered = df.orderBy(F.desc("timestamp"), F.asc("request_id"))
    return (ordered.offset(offset) if offset else ordered).limit(n)


def search_logs(
    df: DataFrame,
    limit: int = 100,
    offset: int = 0,
    level: str | None = None,
    service: str | None = None,
    min_response_ms: int | None = None,
    max_response_ms: int | None = None,
    status_code: int | None = None,
) -> Page:
    """Rows matching all given predicates, newest first."""
    _bounded("limit", limit, 1, MAX_PAGE)
    _bounded("offset", offset, 0)
    _bounded("min_response_ms", min_response_ms, 0)
    _bounded("max_response_ms", max_response_ms, 0)
    _bounded("status_code", status_code, 100, 599)
    level = valid_level(level)
    if level:
        df = df.filter(F.col("log_level") == level)
    if service:
        df = df.filter(F.col("service_name") == service)
    if status_code is not None:
        df = df.filter(F.col("status_code") == status_code)
    if min_response_ms is not None:
        df = df.filter(F.col("response_time_ms") >= min_response_ms)
    if max_response_ms is not None:
        df = df.filter(F.col("response_time_ms") <= max_response_ms)
    return Page(df, newest_first(df, limit, offset))


def search_anomalies(
    df: DataFrame, limit: int = 50, service: str | None = None, min_score: float | None = None
) -> Page:
    """Flagged rows, worst score first."""
    _bounded("limit", limit, 1, MAX_PAGE)
    df = df.filter(F.col("is_anomaly"))
    if service:
        df = df.filter(F.col("service_name") == service)
    if min_score is not None:
        df = df.filter(F.col("anomaly_score") >= min_score)
    worst = df.orderBy(F.desc("anomaly_score"), F.desc("timestamp"), F.asc("request_id")).limit(limit)
    return Page(df, worst)


def recent_logs(stored: DataFrame, limit: int = 50) -> DataFrame:
    """Newest entries of the latest-N log view (JSON in ``value``, ordered by ``score``); corrupt ones are skipped."""
    _bounded("limit", limit, 1, MAX_PAGE)
    return parse_recent(stored.orderBy(F.desc("score"), F.asc("value")).limit(limit))


def recent_alerts(stored: DataFrame, limit: int = 20) -> DataFrame:
    """Newest entries of the alert log (JSON in ``value``, ordered by ``score``); corrupt ones are skipped."""
    _bounded("limit", limit, 1, 100)
    return parse_alerts(stored.orderBy(F.desc("score"), F.asc("value")).limit(limit))


def in_last(
    df: DataFrame, as_of: datetime | Column | None = None, hours: int = 0, minutes: int = 0, open_end: bool = False
) -> DataFrame:
    """Rows of the last hours and minutes, both ends inclusive; ``open_end`` drops the upper bound.

    On a table partitioned by ``log_date`` the same bounds also prune partitions.
    """
    end = instant(as_of)
    start = end - F.expr(f"INTERVAL {hours * 60 + minutes} MINUTES")
    keep = F.col("timestamp") >= start
    if "log_date" in df.columns:
        keep = keep & (F.col("log_date") >= F.to_date(start))
    if not open_end:
        keep = keep & (F.col("timestamp") <= end)
        if "log_date" in df.columns:
            keep = keep & (F.col("log_date") <= F.to_date(end))
    return df.filter(keep)


def count_in_window(df: DataFrame, seconds: float = 60, as_of: datetime | Column | None = None) -> DataFrame:
    """Number of rows in the last ``seconds``, lower end inclusive; prunes days and files as ``in_last`` does."""
    start = F.timestamp_micros(F.unix_micros(instant(as_of)) - F.lit(int(seconds * 1_000_000)))
    keep = F.col("timestamp") >= start
    if "log_date" in df.columns:
        keep = keep & (F.col("log_date") >= F.to_date(start))
    return df.filter(keep).agg(F.count("*").alias("n"))


def over_threshold(df: DataFrame, column: str, threshold: float = 90, name: str = "is_anomaly") -> DataFrame:
    """Plain rule: flag values above a threshold."""
    return df.withColumn(name, F.coalesce(F.col(column) > threshold, F.lit(False)))


def latest_instant(df: DataFrame) -> datetime | None:
    """Newest event time of the table, as an ``as_of`` that prunes partitions."""
    return df.agg(F.max("timestamp")).first()[0]
