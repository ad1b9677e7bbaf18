"""Registered queries that reach the newest rows, or a page far behind them, through a time index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.operators import aggregates as G
from emberlog.operators import search as S
from emberlog.plans.catalog import ENTRIES, query
from emberlog.plans.queries import PAGE, listing, logs
from emberlog.session import fresh_path, stage
from emberlog.sources.history import History
from emberlog.sources.timeindex import TimeIndex, after, minute_counts, newest_matching, page

DAY_US = 86_400_000_000
MINUTE = 60_000_000


def _spread(spark, sf_dir, days: int, apart: int = 1) -> History:
    """The logs dealt over ``days`` days, ``apart`` days from each other; errors are replayed with another status."""
    df = logs(spark, sf_dir)
    moved = F.timestamp_micros(F.col("us") + F.col("seq") % days * F.lit(apart * DAY_US))
    at = F.lit("2025-01-01 00:00:00").cast("timestamp")
    df = df.withColumns({"timestamp": moved, "consumed_at": at})
    history = History(spark, fresh_path(spark, "history"))
    history.append(df, 0)
    history.append(df.filter("is_error").withColumns({"status_code": F.lit(599), "consumed_at": at + F.expr("INTERVAL 1 HOUR")}), 1)
    return history


def _dealt(days: int, apart: int = 1) -> str:
    return (
        f"dealt AS (SELECT * REPLACE (us + seq % {days} * {apart * DAY_US} AS us, CASE WHEN is_error THEN 599 ELSE status_code END AS status_code) FROM logs)"
    )


def _days_read(df: DataFrame) -> int:
    return df.select("log_date").distinct().count()


def _walk_sql(days: int, apart: int) -> str:
    """The 100 newest rows, and the days from the minute on in which the 100th newest stored row (replays counted) lies."""
    return (
        f"{_dealt(days, apart)}, stored AS (SELECT us FROM dealt UNION ALL SELECT us FROM dealt WHERE is_error), "
        f"edge AS (SELECT min(us) - min(us) % {MINUTE} AS us FROM (SELECT us FROM stored ORDER BY us DESC LIMIT 100)), "
        f"w AS (SELECT count(DISTINCT d.us // {DAY_US}) AS days_read FROM dealt d, edge e WHERE d.us >= e.us) => "
        "SELECT d.*, w.days_read >= 1 AND w.days_read <= 60 AS bounded FROM dealt d, w ORDER BY d.us DESC, request_id LIMIT 100"
    )


@query("T1_newest_walk", PAGE + " bounded:b", _walk_sql(60, 1))
def _(spark, sf_dir):
    found = _spread(spark, sf_dir, 60).newest(100)
    rows = S.newest_first(found.withColumn("us", F.unix_micros("timestamp")), 100)
    return rows.withColumn("bounded", F.lit(1 <= _days_read(found) <= 60))


@query("T1_newest_sparse_days", PAGE + " bounded:b", _walk_sql(3, 29))
def _(spark, sf_dir):
    found = _spread(spark, sf_dir, 3, apart=29).newest(100)
    rows = S.newest_first(found.withColumn("us", F.unix_micros("timestamp")), 100)
    return rows.withColumn("bounded", F.lit(1 <= _days_read(found) <= 60))


@query(
    "Q1_search_walk", PAGE,
    f"{_dealt(30)} => SELECT * FROM dealt WHERE log_level = 'ERROR' AND status_code = 599 AND service_name = 'purchase-0' ORDER BY us DESC, request_id LIMIT 40",
)
def _(spark, sf_dir):
    where = (F.col("log_level") == "ERROR") & (F.col("status_code") == 599) & (F.col("service_name") == "purchase-0")
    found = _spread(spark, sf_dir, 30).newest(40, where)
    return S.search_logs(found, limit=40).rows.withColumn("us", F.unix_micros("timestamp"))


def _indexed(spark, sf_dir) -> tuple[DataFrame, TimeIndex]:
    df = logs(spark, sf_dir)
    return df, TimeIndex(stage(minute_counts(df), "index"))


@query("A1_recent_stats_walk", ENTRIES["A1_recent_stats"].columns, ENTRIES["A1_recent_stats"].sql)
def _(spark, sf_dir):
    df, index = _indexed(spark, sf_dir)
    stats = G.recent_stats(newest_matching(df, index, 1000), total=index.total())
    return stats.withColumn("top_services", listing("top_services", "service", "count"))


@query("A5_rolling_summary_walk", ENTRIES["A5_rolling_summary"].columns, ENTRIES["A5_rolling_summary"].sql)
def _(spark, sf_dir):
    df, index = _indexed(spark, sf_dir)
    summary = G.rolling_summary(newest_matching(df, index, 1000))
    return summary.withColumn("top_services", listing("top_services", "service", "count"))


@query(
    "T2_deep_page", PAGE,
    "placed AS (SELECT *, row_number() OVER (ORDER BY us DESC, request_id) - 1 AS place, count(*) OVER () * 7 // 10 AS off FROM logs) => "
    "SELECT * FROM placed WHERE place >= off AND place < off + 200",
)
def _(spark, sf_dir):
    df, index = _indexed(spark, sf_dir)
    return page(df, index, index.total() * 7 // 10, 200)


@query(
    "T2_keyset_page", PAGE,
    "placed AS (SELECT *, row_number() OVER (ORDER BY us DESC, request_id) AS place FROM logs) => "
    "SELECT * FROM placed WHERE place > 200 AND place <= 250",
)
def _(spark, sf_dir):
    df, index = _indexed(spark, sf_dir)
    last = page(df, index, 199, 1).first()
    return S.newest_first(newest_matching(after(df, last["timestamp"], last["request_id"]), index, 50), 50)
