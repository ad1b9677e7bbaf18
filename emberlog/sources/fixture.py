"""A log table out of the columns of ``events``: services from event types, latency and level from event values.

Exact arithmetic only, so that any SQL engine derives the same rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.joins import Incident
from emberlog.session import fresh_path, utc

START_US = 1718421600000000

#: Parts of the covered time, in hundredths, that queries tag or leave out as incidents.
SPANS = (("first", 12, 19), ("second", 41, 47), ("third", 66, 74), ("fourth", 88, 91))


class Rates(NamedTuple):
    """How often rows are slow or bad: divisor of the latency, least cents of a level (``failed``: error level of error events)."""

    pace: int
    critical: int
    error: int
    failed: int
    warn: int


#: About 5 % errors; a row above the anomaly rule's latency always has an error level as well.
RARE = Rates(250000, 26000, 16000, 12000, 9000)
#: About 17 % errors and 27 % anomalies, over a third of these by latency alone.
FREQUENT = Rates(45000, 20000, 16000, 2000, 7000)

LOGS_SQL = """
WITH base AS (SELECT event_id, user_id, event_type, CAST(ROUND(value * 100) AS BIGINT) AS cents,
   event_id * 110000 + {EPOCH_US} % 90000 AS t_us FROM {EVENTS}),
timed AS (SELECT *, CAST(1 + FLOOR(cents * cents / {rates.pace}.0) + user_id % 50 * 10 AS INT) AS response_time_ms,
   CONCAT(event_type, '-', CAST(user_id % 2 AS {STR})) AS service_name FROM base),
graded AS (SELECT *, CASE WHEN cents >= {rates.critical} THEN 'CRITICAL' WHEN cents >= {rates.error} OR (event_type = 'error' AND cents >= {rates.failed}) THEN 'ERROR'
   WHEN cents >= {rates.warn} OR event_type = 'error' THEN 'WARN' ELSE 'INFO' END AS log_level FROM timed)
SELECT {MK_TS} AS timestamp, log_level, service_name,
  CONCAT('/', event_type, CASE WHEN cents % 2 = 0 THEN '' ELSE CONCAT('/', CAST(user_id AS {STR})) END) AS endpoint,
  response_time_ms,
  CAST(CASE log_level WHEN 'CRITICAL' THEN 500 WHEN 'ERROR' THEN 400 + cents % 2 * 103 WHEN 'WARN' THEN 200 + cents % 3 * 100 ELSE 200 END AS INT) AS status_code,
  CONCAT('user-', CAST(user_id AS {STR})) AS user_id,
  CONCAT('10.', CAST(CAST(FLOOR(user_id / 100.0) AS BIGINT) AS {STR}), '.0.', CAST(user_id % 100 AS {STR})) AS ip_address,
  CONCAT(event_type, ' took ', CAST(response_time_ms AS {STR}), ' ms') AS message,
  CONCAT('r', CAST(event_id AS {STR})) AS request_id,
  CONCAT('zone-', CAST(user_id % 4 AS {STR})) AS region,
  'test' AS environment, event_id AS seq
FROM graded
"""

_SPARK = {
    "EPOCH_US": "unix_micros(CAST(ts AS TIMESTAMP))",
    "MK_TS": f"timestamp_micros({START_US} + t_us)",
    "STR": "STRING",
    "EVENTS": "{events}",
}


def raw_logs(spark: SparkSession, sf_dir: str, rates: Rates = RARE) -> DataFrame:
    """The typed log table without derived fields."""
    utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(LOGS_SQL.format(rates=rates, **_SPARK), events=events)


def incidents(df: DataFrame, spans: tuple[tuple[str, int, int], ...] = SPANS) -> list[Incident]:
    """Half-open spans of the time that ``df`` covers."""
    low, high = df.agg(F.min("us"), F.max("us")).first()
    return [Incident(name, low + (high - low) * a // 100, low + (high - low) * b // 100) for name, a, b in spans]


def scored_logs(spark: SparkSession, sf_dir: str, rates: Rates = RARE) -> DataFrame:
    """Enriched logs with a plain rule in place of a model: easy to restate in SQL."""
    from emberlog.operators.parsing import enrich

    df = enrich(raw_logs(spark, sf_dir, rates))
    return df.withColumns(
        {
            "us": F.unix_micros("timestamp"),
            "is_anomaly": F.col("log_level").isin("ERROR", "CRITICAL") | (F.col("response_time_ms") > 2000),
            "anomaly_score": F.col("response_time_ms") / F.lit(10000.0),
        }
    )


_TABLES: dict[tuple[str, str, Rates], str] = {}


def log_table(spark: SparkSession, sf_dir: str, rates: Rates = RARE) -> DataFrame:
    """The scored logs as a stored table partitioned by day, built once per session from ``events``."""
    utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir, rates)
    if key not in _TABLES:
        path = fresh_path(spark, "logs")
        logs = scored_logs(spark, sf_dir, rates).drop("consumed_at").withColumn("log_date", F.to_date("timestamp"))
        # Range-partitioned by time, so that files hold disjoint spans and time predicates skip them.
        logs.repartitionByRange("us").sortWithinPartitions("us").write.partitionBy("log_date").parquet(path)
        _TABLES[key] = path
    return spark.read.parquet(_TABLES[key])
