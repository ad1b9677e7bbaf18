"""Aggregations over the log table. All are partial-then-final hash aggregates, so hot groups combine early."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from emberlog.functions.scalar import epoch_bucket_us, instant, percent, settled
from emberlog.operators.joins import bucket_spine, fill_spine
from emberlog.operators.ordered import exact_quantiles, melt
from emberlog.operators.quantiles import exact_percentiles
from emberlog.operators.search import in_last, newest_first
from emberlog.schema import LEVELS, MICROS, MODEL_FEATURES, RECENT_ROWS

AsOf = datetime | Column | None


def _level_counts() -> dict[str, Column]:
    level = F.coalesce("log_level", F.lit("INFO"))
    return {name: F.count_if(level == name) for name in LEVELS}


def health_band(error_rate: Column) -> Column:
    return F.when(error_rate < 2, "ok").when(error_rate < 8, "warn").otherwise("bad")


def level_distribution(df: DataFrame) -> DataFrame:
    """Count and share of each level; a missing level counts as INFO, unknown ones only in the total."""
    counts = df.agg(F.count("*").alias("total"), *[c.alias(n) for n, c in _level_counts().items()])
    rows = F.array(*[F.struct(F.lit(n).alias("log_level"), F.col(n).alias("n")) for n in LEVELS])
    return counts.select("total", F.inline(rows)).select(
        "log_level", "n", percent(F.col("n"), F.col("total")).alias("pct")
    )


def interpolated_percentile(df: DataFrame, column: str, p: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Exact percentile with linear interpolation at ``(n - 1) * p``.

    Whole numbers keep a counter per distinct value; real values are bracketed by a sketch, so that no task holds all of a group.
    """
    if isinstance(df.schema[column].dataType, IntegralType):
        return df.groupBy(*keys).agg(F.percentile(column, p).alias("value"))
    return exact_percentiles(df, column, [p], keys).select(*keys, F.col("q0").alias("value"))


def top_services(df: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` busiest services with their share of all rows."""
    counts = df.select(F.coalesce("service_name", F.lit("unknown")).alias("service")).rollup("service").agg(
        F.count("*").alias("n"), F.grouping("service").alias("whole")
    )
    top = _with_whole(counts, [F.desc("n"), F.asc("service")], k, "n")
    return top.select("service", "n", percent(F.col("n"), F.col("whole.n")).alias("pct")).orderBy(F.desc("n"), "service")


def _with_whole(rolled: DataFrame, order: list[Column], k: int, *columns: str) -> DataFrame:
    """The first ``k`` groups of a rollup (``whole`` marks the row of all), with ``columns`` of the row of all as a struct ``whole``."""
    top = rolled.orderBy(F.desc("whole"), *order).limit(k + 1)
    everything = F.max(F.when(F.col("whole") == 1, F.struct(*columns))).over(Window.partitionBy(F.lit(0)))  # k + 1 rows
    return top.withColumn("__all", everything).filter("whole = 0").drop("whole").withColumnRenamed("__all", "whole")


def _top_of(services: Column, total: Column, k: int, places: int) -> Column:
    """Top ``k`` of an array of service names (a bounded window of rows) as structs."""
    counted = F.transform(
        F.array_distinct(services),
        lambda s: F.struct((-F.size(F.filter(services, lambda x: x == s))).alias("order"), s.alias("service")),
    )
    return F.transform(
        F.slice(F.array_sort(counted), 1, k),
        lambda s: F.struct(
            s["service"].alias("service"),
            (-s["order"]).alias("count"),
            F.round(-s["order"] / total * 100, places).alias("percentage"),
        ),
    )


def _recent_window(df: DataFrame, n: int, k: int, places: int) -> DataFrame:
    newest = newest_first(
        df.select("timestamp", "request_id", "log_level", "response_time_ms", "is_error", "is_slow", "service_name"), n
    )
    rt = F.col("response_time_ms")
    out = newest.agg(
        F.count("*").alias("window_size"),
        *[c.alias(f"level_{name.lower()}") for name, c in _level_counts().items()],
        F.coalesce(F.avg(rt), F.lit(0.0)).alias("avg"),
        F.coalesce(F.percentile(rt, 0.95), F.lit(0.0)).alias("p95"),
        F.stddev_samp(rt).alias("std"),
        F.coalesce(F.max(rt), F.lit(0)).alias("max"),
        F.count_if("is_error").alias("errors"),
        F.count_if("is_slow").alias("slow"),
        # At most n names.
        F.collect_list(F.coalesce("service_name", F.lit("unknown"))).alias("names"),
    ).filter("window_size > 0")
    total = F.col("window_size")
    return out.withColumns(
        {
            **{f"level_{x.lower()}_pct": F.round(F.col(f"level_{x.lower()}") / total * 100, places) for x in LEVELS},
            "top_services": _top_of(F.col("names"), total, k, places),
        }
    )


def recent_stats(df: DataFrame, n: int = RECENT_ROWS, total: int | None = None) -> DataFrame:
    """Statistics of the newest ``n`` rows plus the table size; no row when the table is empty.

    With ``total`` known, as from a time index, ``df`` may hold just the newest rows and is read once.
    """
    window, stats = F.col("window_size"), _recent_window(df, n, 5, 2)
    if total is None:
        stats = stats.crossJoin(F.broadcast(df.agg(F.count("*").alias("total_in_table"))))  # one row
    else:
        stats = stats.withColumn("total_in_table", F.lit(total))
    return stats.select(
        "window_size", "total_in_table",
        *[F.col(f"level_{x.lower()}{s}") for x in LEVELS for s in ("", "_pct")],
        F.round("avg", 2).alias("avg_response_ms"),
        settled(F.col("p95"), 2).alias("p95_response_ms"),
        F.round(F.col("max").cast("double"), 2).alias("max_response_ms"),
        F.round(F.col("errors") / window * 100, 2).alias("error_rate_pct"),
        F.round(F.col("slow") / window * 100, 2).alias("slow_rate_pct"),
        "top_services",
    )


def rolling_summary(df: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    """Summary of the rolling window of the newest ``n`` rows, with its health band."""
    window = F.col("window_size")
    rate = F.col("errors") / window * 100
    return _recent_window(df, n, 3, 1).select(
        "window_size",
        *[F.col(f"level_{x.lower()}{s}") for x in LEVELS for s in ("", "_pct")],
        F.round("avg", 1).alias("avg_response_ms"),
        settled(F.col("p95"), 1).alias("p95_response_ms"),
        F.round("std", 1).alias("stddev_ms"),
        F.col("max").alias("max_response_ms"),
        F.col("errors").alias("error_count"),
        F.round(rate, 2).alias("error_rate_pct"),
        health_band(rate).alias("health"),
        "top_services",
    )


def service_levels(df: DataFrame, k: int = 20) -> DataFrame:
    """Per service: volume, average latency, errors and level counts; the ``k`` busiest."""
    grouped = df.groupBy(F.col("service_name").alias("service")).agg(*_service_counts())
    return _rated(grouped).orderBy(F.desc("total"), "service").limit(k)


def _service_counts() -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.round(F.coalesce(F.avg("response_time_ms"), F.lit(0.0)), 1).alias("avg_response_ms"),
        F.count_if("is_error").alias("error_count"),
        *[F.count_if(F.col("log_level") == x).alias(f"level_{x.lower()}") for x in LEVELS],
    ]


def _rated(df: DataFrame) -> DataFrame:
    return df.withColumn("error_rate_pct", percent(F.col("error_count"), F.col("total")))


def timeline(df: DataFrame, hours: int = 1, as_of: AsOf = None, width_s: int = 300) -> DataFrame:
    """Zero-filled buckets of the last hours: volume, errors, anomalies, average and 95th percentile latency."""
    if not 1 <= hours <= 24:
        raise ValueError("hours must be 1..24")
    end = F.unix_micros(instant(as_of))
    per_bucket = timeline_buckets(in_last(df, as_of, hours=hours), width_s)
    spine = bucket_spine(df.sparkSession, end - F.lit(hours * 3600 * MICROS), end, width_s)
    filled = fill_spine(
        spine, per_bucket, ("total", "error_count", "anomaly_count", "avg_response_ms", "p95_response_ms")
    )
    return filled.select(
        F.date_format(F.timestamp_micros("bucket_us"), "HH:mm").alias("time"),
        F.expr("bucket_us div 1000").alias("timestamp_epoch"),
        "total", "error_count", "anomaly_count", "avg_response_ms", "p95_response_ms",
    )


def timeline_buckets(df: DataFrame, width_s: int = 300) -> DataFrame:
    """The non-empty buckets of a timeline."""
    bucket = epoch_bucket_us(F.unix_micros("timestamp"), width_s)
    return df.groupBy(bucket.alias("bucket_us")).agg(
        F.count("*").alias("total"),
        F.count_if("is_error").alias("error_count"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.round(F.avg("response_time_ms"), 1).alias("avg_response_ms"),
        settled(F.percentile("response_time_ms", 0.95), 1).alias("p95_response_ms"),
    )


def latency_profile(df: DataFrame, service: str | None = None, approximate: bool = False) -> DataFrame:
    """Percentiles and moments of the latency. ``approximate`` keeps a sketch instead of all distinct values."""
    rows = df.filter(F.col("service_name") == service) if service else df
    out = rows.agg(*_latency_parts(approximate))
    return out.select(*_latency_columns(F.col))


def _latency_parts(approximate: bool = False) -> list[Column]:
    rt, points = F.col("response_time_ms"), (0.5, 0.95, 0.99)
    quantiles = F.percentile_approx(rt, list(points), 10_000) if approximate else F.percentile(rt, F.array(*map(F.lit, points)))
    return [
        F.count("*").alias("total_docs"), quantiles.alias("q"), F.min(rt).alias("lo"), F.max(rt).alias("hi"), F.avg(rt).alias("mean"), F.stddev_pop(rt).alias("std"),
    ]


def _latency_columns(part: Callable[[str], Column]) -> list[Column]:
    def one(c: Column, name: str) -> Column:
        return settled(F.coalesce(c.cast("double"), F.lit(0.0)), 1).alias(name)

    names = {"lo": "min_ms", "hi": "max_ms", "mean": "avg_ms", "std": "stddev_ms"}
    percentiles = [one(F.get(part("q"), i), f"{p}_ms") for i, p in enumerate(("p50", "p95", "p99"))]
    return [part("total_docs").alias("total_docs"), *percentiles, *[one(part(c), n) for c, n in names.items()]]


def service_report(df: DataFrame, hours: int = 1, as_of: AsOf = None) -> DataFrame:
    """Per-service statistics of the last hours beside the global latency profile."""
    if not 1 <= hours <= 24:
        raise ValueError("hours must be 1..24")
    rows = in_last(df, as_of, hours=hours).select(F.col("service_name").alias("service"), "log_level", "response_time_ms", "is_error")
    # Services and the whole are two grouping sets of one scan.
    rolled = rows.rollup("service").agg(*_service_counts(), *_latency_parts(), F.grouping("service").alias("whole"))
    parts = ("total_docs", "q", "lo", "hi", "mean", "std")
    top = _rated(_with_whole(rolled, [F.desc("total"), F.asc("service")], 20, *parts).drop(*parts))
    levels = [c for c in top.columns if c != "whole"]
    return top.select(*levels, *_latency_columns(lambda c: F.col("whole")[c])).orderBy(F.desc("total"), "service")


def anomalies_by_service(df: DataFrame, as_of: AsOf = None, minutes: int = 30, k: int = 10) -> DataFrame:
    """Per service: anomalies of the last minutes, their average score, share, and the worst row."""
    recent = in_last(df.filter("is_anomaly"), as_of, minutes=minutes, open_end=True)
    worst = F.struct(
        "timestamp", "log_level", "endpoint", F.col("response_time_ms").alias("response_ms"),
        F.round("anomaly_score", 4).alias("score"), F.substring("message", 1, 80).alias("message"),
    )
    rolled = recent.withColumn("service", F.col("service_name")).rollup("service").agg(
        F.count("*").alias("anomaly_count"),
        F.round(F.avg("anomaly_score"), 4).alias("avg_anomaly_score"),
        F.max_by(worst, F.struct("anomaly_score", "timestamp", "request_id")).alias("worst_log"),
        F.grouping("service").alias("whole"),
    )
    top = _with_whole(rolled, [F.desc("anomaly_count"), F.asc("service")], k, "anomaly_count").withColumn("total_anomalies", F.col("whole.anomaly_count")).drop("whole")
    return top.withColumn("pct_of_total", percent(F.col("anomaly_count"), F.col("total_anomalies"), 1)).orderBy(F.desc("anomaly_count"), "service")


def anomaly_buckets(df: DataFrame, as_of: AsOf = None, hours: int = 1, width_s: int = 600) -> DataFrame:
    """Zero-filled anomaly counts of the last hours."""
    end = F.unix_micros(instant(as_of))
    rows = in_last(df.filter("is_anomaly"), as_of, hours=hours)
    per_bucket = rows.groupBy(epoch_bucket_us(F.unix_micros("timestamp"), width_s).alias("bucket_us")).agg(
        F.count("*").alias("n")
    )
    spine = bucket_spine(df.sparkSession, end - F.lit(hours * 3600 * MICROS), end, width_s)
    return fill_spine(spine, per_bucket, ("n",)).select(
        "bucket_us", F.date_format(F.timestamp_micros("bucket_us"), "HH:mm").alias("time"), "n"
    )


def anomaly_stats(df: DataFrame, as_of: AsOf = None, hours: int = 1) -> DataFrame:
    """One row: anomalies, their rate, bucket counts, the peak bucket (earliest on a tie) and the top services."""
    width_s, end = 600, F.unix_micros(instant(as_of))
    bucket = epoch_bucket_us(F.unix_micros("timestamp"), width_s)
    rows = in_last(df, as_of, hours=hours).select(F.col("service_name").alias("service"), bucket.alias("bucket_us"), "is_anomaly")
    # Totals, buckets and services are three grouping sets of one scan; what follows works on one row for each group.
    sets = rows.groupingSets([[F.col("bucket_us")], [F.col("service")], []], F.col("bucket_us"), F.col("service")).agg(
        F.count("*").alias("rows"), F.count_if("is_anomaly").alias("n"), F.grouping("bucket_us").alias("gb"), F.grouping("service").alias("gs")
    )
    # Services with the most anomalies combine per task before they meet; buckets are bounded by the hours.
    kept = sets.filter((F.col("gs") == 1) | (F.col("n") > 0))
    services = Window.partitionBy("gs").orderBy(F.desc("n"), "service")
    kept = kept.withColumn("r", F.row_number().over(services)).filter((F.col("gs") == 1) | (F.col("r") <= 5))
    of = lambda keep, value: F.collect_list(F.when(keep, value))
    one = kept.agg(
        F.sum(F.when((F.col("gb") == 1) & (F.col("gs") == 1), F.col("rows"))).alias("logs"), F.sum(F.when((F.col("gb") == 1) & (F.col("gs") == 1), F.col("n"))).alias("anomalies"),
        of((F.col("gb") == 0), F.struct("bucket_us", "n")).alias("found"), of(F.col("gs") == 0, F.struct((-F.col("n")).alias("neg"), "service")).alias("s"),
    )
    low, high = end - F.lit(hours * 3600 * MICROS), end
    step = F.lit(width_s * MICROS)
    spine = F.sequence(low - F.pmod(low, step), high - F.pmod(high, step), step)
    counts = F.map_from_entries("found")
    by_bucket = F.transform(spine, lambda t: F.struct(
        t.alias("bucket_us"), F.date_format(F.timestamp_micros(t), "HH:mm").alias("time"), F.coalesce(F.try_element_at(counts, t), F.lit(0).cast("long")).alias("n")))
    one = one.select("*", by_bucket.alias("b"), F.coalesce("logs", F.lit(0)).alias("total_logs"), F.coalesce("anomalies", F.lit(0)).alias("total_anomalies"))
    peak = F.get(F.array_sort(F.transform("b", lambda x: F.struct((-x["n"]).alias("neg"), x["bucket_us"].alias("at"), x["time"].alias("time")))), 0)
    return one.select(
        "total_logs", "total_anomalies", percent(F.col("total_anomalies"), F.col("total_logs")).alias("anomaly_rate_pct"),
        peak["time"].alias("peak_bucket"), (-peak["neg"]).alias("peak_count"),
        F.transform("b", lambda x: F.struct(x["time"].alias("time"), x["n"].alias("count"))).alias("by_bucket"),
        F.transform(F.array_sort("s"), lambda x: F.struct(x["service"].alias("service"), (-x["neg"]).alias("anomaly_count"))).alias("top_services"),
    )


def scoring_counters(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Scored rows, anomalies, their rate and distinct addresses."""
    ips = F.approx_count_distinct("ip_address") if approximate else F.count_distinct("ip_address")
    return df.agg(
        F.count("*").alias("scored"), F.count_if("is_anomaly").alias("anomalies"), ips.alias("unique_ips")
    ).withColumn("anomaly_rate", F.when(F.col("scored") > 0, F.col("anomalies") / F.col("scored")).otherwise(0.0))


def feature_stats(df: DataFrame, features: tuple[str, ...] = MODEL_FEATURES) -> DataFrame:
    """Long table of statistics per feature; quantiles are exact at any number of distinct values."""
    long = melt(df, features)
    value = F.col("value")
    # One row per feature name in both aggregates.
    moments = long.groupBy("feature").agg(
        F.round(F.avg(value), 4).alias("mean"),
        F.round(F.stddev_samp(value), 4).alias("std"),
        F.round(F.min(value), 4).alias("min"),
        F.round(F.max(value), 4).alias("max"),
        F.round(F.count_if(value.isNull()) / F.count("*") * 100, 3).alias("null_pct"),
        F.round(F.avg(value), 6).alias("scaler_mean"),
        F.round(F.stddev_pop(value), 6).alias("scaler_std"),
    )
    names = ("p25", "median", "p75", "p95", "p99")
    quantiles = exact_quantiles(long, (0.25, 0.5, 0.75, 0.95, 0.99))
    picked = quantiles.select("feature", *[F.round(f"q{i}", 4).alias(n) for i, n in enumerate(names)])
    return moments.join(F.broadcast(picked), "feature", "left").select(
        "feature", "mean", "std", "min", *names, "max", "null_pct", "scaler_mean", "scaler_std"
    )


def requests_per_ip(df: DataFrame) -> DataFrame:
    """Smallest, average and largest request count per address, and the number of addresses."""
    per_ip = df.groupBy("ip_address").agg(F.count("*").alias("n"))
    return per_ip.agg(
        F.min("n").alias("min_requests"), F.round(F.avg("n"), 4).alias("mean_requests"),
        F.max("n").alias("max_requests"), F.count("*").alias("unique_ips"),
    )


def split_error_rates(df: DataFrame) -> DataFrame:
    """Share of HTTP errors in each split."""
    return df.groupBy("split").agg(F.count("*").alias("n"), F.avg("is_http_error").alias("error_rate"))


def partition_inventory(df: DataFrame, as_of: AsOf = None, max_age_days: int = 7) -> DataFrame:
    """Rows, span, age and phase of each day of the history."""
    today = F.to_date(instant(as_of))
    age = F.date_diff(today, F.col("log_date"))
    return df.groupBy("log_date").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")
    ).withColumns(
        {"age_days": age, "phase": F.when(age > max_age_days, "expired").when(age >= 1, "warm").otherwise("hot")}
    )
