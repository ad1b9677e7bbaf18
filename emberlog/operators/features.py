"""Model features in their training (time window) and serving (last rows) forms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions import scalar as X
from emberlog.operators.joins import sized
from emberlog.operators.ordered import ranked, running_totals, split_order, trailing_rows, trailing_totals
from emberlog.schema import (
    COLD_START_AVG_RESPONSE,
    COLD_START_ERROR_RATE,
    DEFAULT_RT_MEAN,
    DEFAULT_RT_STD,
    LEGACY_AVG_RESPONSE,
    LEGACY_ERROR_RATE,
    LEGACY_FEATURES,
    MICROS,
    MODEL_FEATURES,
    ROLLING_WINDOW_S,
    WARM_UP_ROWS,
)


def base_features(df: DataFrame) -> DataFrame:
    """Add the cleaned latency ``rt``, ``is_http_error`` and ``log_level_int``."""
    return df.withColumns(
        {
            "rt": X.clean_response(F.col("response_time_ms")),
            "is_http_error": X.is_http_error(F.col("status_code")),
            "log_level_int": X.level_int(F.upper("log_level"), 0),
        }
    )


def _exact(df: DataFrame) -> Column:
    """The latency as an exact number, so that sums of entries and departures cancel."""
    integral = isinstance(df.schema["response_time_ms"].dataType, (T.IntegerType, T.LongType, T.ShortType))
    return F.col("rt").cast("bigint" if integral else "decimal(28,6)")


def response_moments(df: DataFrame) -> DataFrame:
    """One row: mean and sample deviation of the cleaned latency."""
    rt = X.clean_response(F.col("response_time_ms"))
    return df.agg(F.avg(rt).alias("rt_mean"), F.stddev_samp(rt).alias("rt_std"))


def serving_stats(df: DataFrame) -> dict[str, float]:
    """Mean and sample deviation of the cleaned latency to four places, as serving takes them from the data a model was fitted on."""
    row = response_moments(df).select(F.round("rt_mean", 4), F.round("rt_std", 4)).first()
    return {"mean": float(row[0] or 0.0), "std": float(row[1] or 0.0)}


def batch_features(
    df: DataFrame, instant: str = "us", tie: str = "seq", rows_per_bucket: int | None = None
) -> DataFrame:
    """Training features: global z-score, five-minute trailing error rate and latency, requests per address.

    Also adds ``rank``, the position in time order, from the same pass. ``response_time_ms`` and ``is_error``
    are replaced by their feature forms.
    """
    base = base_features(df)
    one = F.lit(1).cast("bigint")
    rolled = trailing_totals(
        base, instant, tie, ROLLING_WINDOW_S * MICROS,
        {"w_n": one, "w_err": F.col("is_http_error").cast("bigint"), "w_rt": _exact(base)},
        overall={"rank": one}, rows_per_bucket=rows_per_bucket,
    )
    per_ip = sized(df.groupBy("ip_address").agg(F.count("*").alias("request_count_per_ip")), name="per-ip")
    # One row.
    moments = F.broadcast(response_moments(df))
    joined = rolled.crossJoin(moments).join(per_ip, "ip_address", "left")
    features = {
        "response_time_ms": F.col("rt"),
        "response_time_zscore": F.when(F.col("rt_std") > 0, (F.col("rt") - F.col("rt_mean")) / F.col("rt_std")),
        "is_error": F.col("is_http_error").cast("double"),
        "log_level_int": F.col("log_level_int").cast("double"),
        "error_rate_5min": F.col("w_err") / F.col("w_n"),
        "avg_response_5min": (F.col("w_rt") / F.col("w_n")).cast("double"),
        "request_count_per_ip": F.col("request_count_per_ip").cast("double"),
    }
    out = joined.withColumns(features).drop("rt", "rt_mean", "rt_std", "w_n", "w_err", "w_rt")
    return fill_missing(out)


def fill_missing(df: DataFrame) -> DataFrame:
    """Remaining nulls of the features become 0."""
    return df.fillna(0.0, subset=list(MODEL_FEATURES))


def zscore(rt: Column, mean: float = DEFAULT_RT_MEAN, std: float = DEFAULT_RT_STD) -> Column:
    return (rt - F.lit(mean)) / F.lit(std + 1e-10)


def blended(total: Column, n: Column, base: float, depth: int = WARM_UP_ROWS) -> Column:
    """Mean of the last rows; until there are ``depth`` of them the missing ones count as ``base``."""
    return ((total + (F.lit(depth) - n) * F.lit(base)) / F.lit(depth)).cast("double")


def serving_features(
    df: DataFrame,
    instant: str = "us",
    tie: str = "seq",
    stats: Mapping[str, float] | None = None,
    rows_per_bucket: int | None = None,
    rows_per_block: int = 100_000,
) -> DataFrame:
    """Serving features: last-100-row error rate and latency with cold start, running requests per address.

    Adds ``window_size`` and ``is_warm``.
    """
    stats = stats or {}
    base = base_features(df)
    splits = split_order(base, (instant, tie), rows_per_bucket)
    one = F.lit(1).cast("bigint")
    numbered = running_totals(base, (instant, tie), {"rank": one}, splits=splits)
    counted = running_totals(numbered, (instant, tie), {"ip_n": one}, ("ip_address",), splits=splits)
    return serving_from_rank(counted, stats, rows_per_block).drop("ip_n")


def serving_from_rank(
    df: DataFrame, stats: Mapping[str, float], rows_per_block: int = 100_000
) -> DataFrame:
    """The serving features of rows that carry ``rt``, ``is_http_error``, ``rank`` and ``ip_n``."""
    rolled = trailing_rows(
        df, "rank", WARM_UP_ROWS,
        {"w_err": F.col("is_http_error").cast("bigint"), "w_rt": _exact(df)},
        rows_per_block,
    )
    n = F.least(F.col("rank"), F.lit(WARM_UP_ROWS))
    return rolled.withColumns(
        {
            "window_size": n.cast("int"),
            "is_warm": n >= WARM_UP_ROWS,
            "response_time_zscore": zscore(
                F.col("rt"), stats.get("mean", DEFAULT_RT_MEAN), stats.get("std", DEFAULT_RT_STD)
            ),
            "response_time_ms": F.col("rt"),
            "is_error": F.col("is_http_error").cast("double"),
            "log_level_int": F.col("log_level_int").cast("double"),
            "error_rate_5min": blended(F.col("w_err"), n, COLD_START_ERROR_RATE),
            "avg_response_5min": blended(F.col("w_rt"), n, COLD_START_AVG_RESPONSE),
            "request_count_per_ip": F.col("ip_n").cast("double"),
        }
    ).drop("rt", "w_err", "w_rt")


def legacy_features(
    df: DataFrame, instant: str = "us", tie: str = "seq", rows_per_bucket: int | None = None,
    rows_per_block: int = 100_000,
) -> DataFrame:
    """The older six-feature form: last 100 rows, with fixed values until the window is full."""
    numbered = ranked(base_features(df), (instant, tie), rows_per_bucket=rows_per_bucket)
    rolled = trailing_rows(
        numbered, "rank", WARM_UP_ROWS,
        {"w_err": F.when(X.is_error(F.col("log_level")), 1).otherwise(0).cast("bigint"), "w_rt": _exact(numbered)},
        rows_per_block,
    )
    full = F.col("rank") >= WARM_UP_ROWS
    out = rolled.withColumns(
        {
            "response_time_ms": F.col("rt"),
            "status_code": F.col("status_code").cast("double"),
            "log_level_int": F.col("log_level_int").cast("double"),
            "error_rate_5min": F.when(full, (F.col("w_err") / WARM_UP_ROWS).cast("double")).otherwise(LEGACY_ERROR_RATE),
            "avg_response_5min": F.when(full, (F.col("w_rt") / WARM_UP_ROWS).cast("double")).otherwise(LEGACY_AVG_RESPONSE),
            "hour_of_day": F.hour("timestamp").cast("double"),
        }
    )
    return out.select(instant, tie, "rank", *LEGACY_FEATURES)
