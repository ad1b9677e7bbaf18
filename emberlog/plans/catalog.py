"""Registry of named queries: a Spark function, optionally the SQL it must agree with, and the result columns.

The column list gives each result column a type on both sides: ``i`` integer, ``d`` number rounded to six
places, ``s`` text, ``b`` boolean.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.session import utc
from emberlog.sources.fixture import LOGS_SQL, RARE, START_US, Rates

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    plan: Plan
    columns: str
    sql: str | None
    rates: Rates


ENTRIES: dict[str, Entry] = {}


def _spark_column(spec: str) -> Column:
    name, kind = spec.split(":")
    c = F.col(name)
    shaped = {"i": c.cast("bigint"), "d": F.round(c.cast("double"), 6), "s": c.cast("string"), "b": c.cast("boolean")}
    return shaped[kind].alias(name)


def _sql_column(spec: str) -> str:
    name, kind = spec.split(":")
    shaped = {
        "i": f"CAST({name} AS BIGINT)", "d": f"ROUND(CAST({name} AS DOUBLE), 6)", "s": f"CAST({name} AS VARCHAR)",
        "b": f"CAST({name} AS BOOLEAN)",
    }
    return f"{shaped[kind]} AS {name}"


def query(name: str, columns: str, sql: str | None = None, rates: Rates = RARE) -> Callable[[Plan], Plan]:
    """Register a plan under ``name``; ``rates`` are those of the log table that it reads."""

    def add(plan: Plan) -> Plan:
        ENTRIES[name] = Entry(plan, columns, sql, rates)
        return plan

    return add


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = ENTRIES[name]
    return entry.plan(utc(spark), sf_dir).select(*[_spark_column(c) for c in entry.columns.split()])


_DUCK = {
    "EPOCH_US": "epoch_us(ts)",
    "MK_TS": f"make_timestamp({START_US} + t_us)",
    "STR": "VARCHAR",
    "EVENTS": "events",
}


def logs_cte(rates: Rates) -> str:
    return f"""WITH raw AS MATERIALIZED ({LOGS_SQL.format(rates=rates, **_DUCK)}),
logs AS MATERIALIZED (SELECT *, epoch_us(timestamp) AS us,
  CASE log_level WHEN 'INFO' THEN 0 WHEN 'WARN' THEN 1 WHEN 'ERROR' THEN 2 ELSE 3 END AS level_int,
  log_level IN ('ERROR','CRITICAL') AS is_error, response_time_ms > 1000 AS is_slow,
  status_code // 100 AS status_class, status_code >= 500 AS is_server_error,
  hour(timestamp) AS hour_of_day, isodow(timestamp) - 1 AS day_of_week,
  length(endpoint) - length(replace(endpoint, '/', '')) AS endpoint_depth,
  (log_level IN ('ERROR','CRITICAL') OR response_time_ms > 2000) AS is_anomaly,
  response_time_ms / 10000.0 AS anomaly_score FROM raw),
now_ AS MATERIALIZED (SELECT max(us) AS now_us FROM logs)"""


def sql_of(name: str) -> str | None:
    entry = ENTRIES[name]
    if entry.sql is None:
        return None
    ctes, _, body = entry.sql.rpartition("=>")
    more = f",\n{ctes.strip()}" if ctes.strip() else ""
    shaped = ", ".join(_sql_column(c) for c in entry.columns.split())
    return f"{logs_cte(entry.rates)}{more},\nresult AS ({body.strip()})\nSELECT {shaped} FROM result"
