"""Registered queries on rollups that were written in batches, with late rows, a batch that came twice and a merged day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.plans.catalog import query
from emberlog.plans.queries import logs
from emberlog.session import fresh_path
from emberlog.sources.rollup import DISTINCT_ERROR, RANK_ERROR, Rollup

WIDTH_US, SLICES = 300_000_000, 4
#: Rows of every seventh number come two slices late.
LATE = 7


def _rolled(spark, sf_dir) -> tuple[DataFrame, Rollup, int, int]:
    """The logs, their rollup, and the first and last instant."""
    df = logs(spark, sf_dir)
    low, high = df.agg(F.min("us"), F.max("us")).first()
    own = F.expr(f"cast(us - {low}L as long) div {(high - low) // SLICES + 1}L")
    batch = own + F.when(F.col("seq") % LATE == 0, 2).otherwise(0)
    rollup = Rollup(spark, fresh_path(spark, "rollup"))
    for k in range(SLICES + 2):
        rollup.append(df.filter(batch == k), k)
        if k == 2:
            for day in rollup.days():
                rollup.compact(day, 2)
    rollup.append(df.filter(batch == 1), 1)  # again, after the merge
    rollup.append(df.filter(batch == 4), 4)  # again
    return df, rollup, low, high


def _in_bound(rows: DataFrame, got: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Whether each percentile of ``got`` has a rank within three times ``RANK_ERROR`` (and one row) of its share among ``rows``."""
    asked = got.select(*[F.col(k).alias(f"_{k}") for k in keys], *shares)
    on: Column = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    ms = F.col("response_time_ms")
    counts = [F.sum((ms < F.floor(c)).cast("long")).alias(f"below_{c}") for c in shares] + [F.sum((ms <= F.ceil(c)).cast("long")).alias(f"upto_{c}") for c in shares]
    ranks = rows.join(asked, on).groupBy(*[f"_{k}" for k in keys]).agg(F.count("*").alias("n"), *counts)
    fits = [
        (F.col(f"below_{c}") <= F.col("n") * (q + 3 * RANK_ERROR) + 1) & (F.col(f"upto_{c}") >= F.col("n") * (q - 3 * RANK_ERROR) - 1)
        for c, q in shares.items()
    ]
    return ranks.select(*[F.col(f"_{k}").alias(k) for k in keys], reduce(lambda a, b: a & b, fits).alias("in_bound"))


@query(
    "A8_rollup_timeline", "bucket_us:i total:i error_count:i anomaly_count:i avg_response_ms:d in_bound:b",
    "spine AS (SELECT unnest(generate_series((now_us - 86400000000) - (now_us - 86400000000) % 300000000, now_us, 300000000)) AS bucket_us "
    "FROM now_), per AS (SELECT us - us % 300000000 AS bucket_us, count(*) AS total, count(*) FILTER (is_error) AS error_count, "
    "count(*) FILTER (is_anomaly) AS anomaly_count, round(avg(response_time_ms), 1) AS avg_response_ms FROM logs GROUP BY 1) => "
    "SELECT s.bucket_us, coalesce(total, 0) AS total, coalesce(error_count, 0) AS error_count, coalesce(anomaly_count, 0) AS anomaly_count, "
    "coalesce(avg_response_ms, 0) AS avg_response_ms, true AS in_bound FROM spine s LEFT JOIN per p ON s.bucket_us = p.bucket_us",
)
def _(spark, sf_dir):
    df, rollup, _, high = _rolled(spark, sf_dir)
    got = rollup.timeline(high, hours=24)
    rows = df.withColumn("bucket_us", F.col("us") - F.col("us") % WIDTH_US)
    fits = _in_bound(rows, got, ["bucket_us"], {"p95_response_ms": 0.95})
    return got.join(fits, "bucket_us", "left").withColumn("in_bound", F.coalesce("in_bound", F.col("total") == 0))


@query(
    "A9_rollup_latency", "service_name:s total:i min_ms:d max_ms:d avg_ms:d stddev_ms:d in_bound:b addresses_in_bound:b",
    "SELECT service_name, count(*) AS total, min(response_time_ms) AS min_ms, max(response_time_ms) AS max_ms, "
    "round(avg(response_time_ms), 1) AS avg_ms, round(stddev_pop(response_time_ms), 1) AS stddev_ms, true AS in_bound, "
    "true AS addresses_in_bound FROM logs GROUP BY 1",
)
def _(spark, sf_dir):
    df, rollup, low, high = _rolled(spark, sf_dir)
    got = rollup.latency(low - low % WIDTH_US, high + 1, ["service_name"])
    fits = _in_bound(df, got, ["service_name"], {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99})
    exact = df.groupBy("service_name").agg(F.countDistinct("ip_address").alias("n"))
    near = F.abs(F.col("addresses") - F.col("n")) <= F.col("n") * 3 * DISTINCT_ERROR + 1
    return got.join(fits, "service_name").join(exact, "service_name").withColumn("addresses_in_bound", near)
