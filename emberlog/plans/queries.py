"""

SQL bodies read the CTEs ``logs`` and ``now_``; a body may put further CTEs in front of ``=>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions import scalar as X
from emberlog.operators import aggregates as G
from emberlog.operators import alerts as A
from emberlog.operators import features as Fe
from emberlog.operators import parsing as P
from emberlog.operators import search as S
from emberlog.operators.dedupe import keep_latest
from emberlog.operators.joins import bucket_spine, exclude_incidents, fill_spine, recurring_incidents, tag_incidents
from emberlog.operators.models import evaluation as E
from emberlog.operators.models.scaling import temporal_split
from emberlog.operators.ordered import ranked
from emberlog.plans.catalog import ENTRIES, query
from emberlog.schema import MICROS, MODEL_FEATURES
from emberlog.sources.fixture import FREQUENT, RARE, SPANS, START_US, Rates, incidents, log_table

FEATURE_INPUT = (
    "us", "seq", "timestamp", "log_level", "service_name", "status_code", "response_time_ms", "ip_address",
)


def logs(spark: SparkSession, sf_dir: str, rates: Rates = RARE) -> DataFrame:
    return log_table(spark, sf_dir, rates)


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs(spark, sf_dir).select(*FEATURE_INPUT)


def listing(column: str, *fields: str) -> F.Column:
    """An array of structs as ``a:b,a:b`` text."""
    return F.array_join(
        F.transform(column, lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])), ","
    ).alias(column)


# --- projections ---------------------------------------------------------------------------------------------

@query(
    "P08_enrich",
    "request_id:s level_int:i is_error:b is_slow:b status_class:i is_server_error:b hour_of_day:i day_of_week:i endpoint_depth:i",
    "SELECT * FROM logs",
)
def _(spark, sf_dir):
    return P.enrich(logs(spark, sf_dir))


@query(
    "P17_numeric_features",
    "request_id:s response_time_ms:d status_code:d level_int:d status_class:d is_error:d is_slow:d is_server_error:d "
    "hour_of_day:d day_of_week:d endpoint_depth:d",
    "SELECT * REPLACE (CAST(is_error AS INT) AS is_error, CAST(is_slow AS INT) AS is_slow, "
    "CAST(is_server_error AS INT) AS is_server_error) FROM logs",
)
def _(spark, sf_dir):
    return P.numeric_features(logs(spark, sf_dir)).select("request_id", "features.*")


@query(
    "P19_api_projection",
    "us:i log_level:s service_name:s endpoint:s response_time_ms:i status_code:i user_id:s ip_address:s message:s "
    "request_id:s region:s environment:s is_error:b is_slow:b level_int:i hour_of_day:i",
    "SELECT * FROM logs",
)
def _(spark, sf_dir):
    return P.api_projection(logs(spark, sf_dir)).withColumn("us", F.unix_micros("timestamp"))


@query(
    "P20_alert_sample",
    "timestamp:s service_name:s log_level:s endpoint:s response_time_ms:i status_code:i anomaly_score:d message:s",
    "SELECT strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp, service_name, log_level, endpoint, "
    "response_time_ms, status_code, round(anomaly_score, 4) AS anomaly_score, substr(message, 1, 120) AS message "
    "FROM logs WHERE is_anomaly",
    rates=FREQUENT,
)
def _(spark, sf_dir):
    return logs(spark, sf_dir, FREQUENT).filter("is_anomaly").select(P.sample_log().alias("s")).select("s.*")


@query(
    "X02_scalar_functions",
    "request_id:s shout:s trimmed:s head:s slashes:i class:i rounded:d clipped:i filled:s per_min:d iso:s epoch_s:d",
    "SELECT request_id, upper(service_name) AS shout, trim(concat('  ', message, ' ')) AS trimmed, "
    "substr(endpoint, 1, 7) AS head, length(endpoint) - length(replace(endpoint, '/', '')) AS slashes, "
    "status_code // 100 AS class, round(response_time_ms / 7.0, 2) AS rounded, "
    "greatest(response_time_ms - 100, 0) AS clipped, coalesce(CASE WHEN NOT is_slow THEN region END, 'none') AS filled, "
    "round(level_int / 60.0 * 60, 1) AS per_min, strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS iso, "
    "us / 1000000.0 AS epoch_s FROM logs",
)
def _(spark, sf_dir):
    return logs(spark, sf_dir).select(
        "request_id", F.upper("service_name").alias("shout"),
        F.trim(F.concat(F.lit("  "), "message", F.lit(" "))).alias("trimmed"),
        F.substring("endpoint", 1, 7).alias("head"), X.count_char(F.col("endpoint"), "/").alias("slashes"),
        F.expr("status_code div 100").alias("class"), F.round(F.col("response_time_ms") / 7.0, 2).alias("rounded"),
        F.greatest(F.col("response_time_ms") - 100, F.lit(0)).alias("clipped"),
        F.coalesce(F.when(~F.col("is_slow"), F.col("region")), F.lit("none")).alias("filled"), X.per_minute(F.col("level_int"), 60).alias("per_min"),
        X.iso_text(F.col("timestamp")).alias("iso"), (F.unix_micros("timestamp") / 1e6).alias("epoch_s"),
    )


# --- search --------------------------------------------------------------------------------------------------

PAGE = "request_id:s us:i log_level:s service_name:s response_time_ms:i status_code:i"


@query("Q1_search_default", PAGE, "SELECT * FROM logs ORDER BY us DESC, request_id LIMIT 100")
def _(spark, sf_dir):
    return S.search_logs(logs(spark, sf_dir)).rows


@query(
    "Q1_search_filtered", PAGE,
    "SELECT * FROM logs WHERE log_level = 'ERROR' AND service_name = 'view-1' AND status_code = 503 "
    "AND response_time_ms BETWEEN 200 AND 1500 ORDER BY us DESC, request_id LIMIT 500",
)
def _(spark, sf_dir):
    return S.search_logs(
        logs(spark, sf_dir), limit=500, level="error", service="view-1", status_code=503,
        min_response_ms=200, max_response_ms=1500,
    ).rows


@query("Q1_search_total", "total:i", "SELECT count(*) AS total FROM logs WHERE log_level = 'WARN' AND response_time_ms >= 100")
def _(spark, sf_dir):
    page = S.search_logs(logs(spark, sf_dir), level="WARN", min_response_ms=100)
    return page.matches.agg(F.count("*").alias("total"))


@query(
    "Q3_anomaly_search", PAGE + " anomaly_score:d",
    "SELECT * FROM logs WHERE is_anomaly AND service_name = 'signup-0' AND anomaly_score >= 0.12 "
    "ORDER BY anomaly_score DESC, us DESC, request_id LIMIT 50",
)
def _(spark, sf_dir):
    return S.search_anomalies(logs(spark, sf_dir), service="signup-0", min_score=0.12).rows


@query(
    "Q3_worst_anomalies", PAGE + " anomaly_score:d",
    "SELECT * FROM logs WHERE is_anomaly ORDER BY anomaly_score DESC, us DESC, request_id LIMIT 500",
    rates=FREQUENT,
)
def _(spark, sf_dir):
    return S.search_anomalies(logs(spark, sf_dir, FREQUENT), limit=500).rows


@query(
    "Q6_last_hour", "n:i first_us:i last_us:i",
    "SELECT count(*) AS n, min(us) AS first_us, max(us) AS last_us FROM logs, now_ "
    "WHERE us BETWEEN now_us - 3600000000 AND now_us",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir)
    rows = S.in_last(df, S.latest_instant(df), hours=1)
    return rows.agg(F.count("*").alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))


@query("Q7_count_last_minute", "n:i", "SELECT count(*) AS n FROM logs, now_ WHERE us >= now_us - 60000000")
def _(spark, sf_dir):
    df = logs(spark, sf_dir)
    return S.count_in_window(df, 60, S.latest_instant(df))


@query("Q8_table_size", "n:i", "SELECT count(*) AS n FROM logs")
def _(spark, sf_dir):
    return logs(spark, sf_dir).agg(F.count("*").alias("n"))


@query(
    "Q9_threshold_rule", "event_id:i value:d flagged:b",
    "SELECT event_id, value, value > 90 AS flagged FROM events",
)
def _(spark, sf_dir):
    return S.over_threshold(spark.read.parquet(f"{sf_dir}/events.parquet"), "value", 90, "flagged")


@query("T1_newest", PAGE, "SELECT * FROM logs ORDER BY us DESC, request_id LIMIT 1000")
def _(spark, sf_dir):
    return S.newest_first(logs(spark, sf_dir), 1000)


@query("T2_offset_page", PAGE, "SELECT * FROM logs ORDER BY us DESC, request_id LIMIT 50 OFFSET 200")
def _(spark, sf_dir):
    return S.search_logs(logs(spark, sf_dir), limit=50, offset=200).rows


@query(
    "T3_worst_per_service", "service_name:s request_id:s anomaly_score:d",
    "SELECT service_name, request_id, anomaly_score FROM logs "
    "QUALIFY row_number() OVER (PARTITION BY service_name ORDER BY anomaly_score DESC, us DESC, request_id DESC) = 1",
)
def _(spark, sf_dir):
    worst = F.max_by(F.struct("request_id", "anomaly_score"), F.struct("anomaly_score", "us", "request_id"))
    return logs(spark, sf_dir).groupBy("service_name").agg(worst.alias("w")).select("service_name", "w.*")


@query("T4_time_rank", "request_id:s rank:i", "SELECT request_id, row_number() OVER (ORDER BY us, seq) AS rank FROM logs")
def _(spark, sf_dir):
    return ranked(logs(spark, sf_dir).select("request_id", "us", "seq"), ("us", "seq"))


#: Rows per bucket of the ``_split`` queries: many buckets also on small tables.
FEW = 137


@query("T4_time_rank_split", ENTRIES["T4_time_rank"].columns, ENTRIES["T4_time_rank"].sql)
def _(spark, sf_dir):
    return ranked(logs(spark, sf_dir).select("request_id", "us", "seq"), ("us", "seq"), rows_per_bucket=FEW)


@query(
    "D1_keep_latest", "request_id:s us:i status_code:i version:s",
    "copies AS (SELECT request_id, us, status_code, 'a' AS version FROM logs UNION ALL "
    "SELECT request_id, us + 5, 599, 'b' FROM logs WHERE status_code >= 400 UNION ALL "
    "SELECT '', us, status_code, 'c' FROM logs WHERE is_slow) => "
    "SELECT * FROM copies WHERE request_id = '' UNION ALL SELECT * FROM copies WHERE request_id <> '' "
    "QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY us DESC) = 1",
    rates=FREQUENT,
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir, FREQUENT).select("request_id", "us", "status_code", "is_slow")
    first = df.withColumn("version", F.lit("a"))
    replayed = df.filter("status_code >= 400").withColumns(
        {"us": F.col("us") + 5, "status_code": F.lit(599), "version": F.lit("b")}
    )
    anonymous = df.filter("is_slow").withColumns({"request_id": F.lit(""), "version": F.lit("c")})
    return keep_latest(first.unionByName(replayed).unionByName(anonymous), order=("us",))


# --- joins ---------------------------------------------------------------------------------------------------

CYCLE = f"(us - {START_US}) // 1000000 % 1800"


def incidents_until(df: DataFrame, spans=E.INCIDENT_SPANS):
    return recurring_incidents(spans, START_US, 1800, df.agg(F.max("us")).first()[0])


@query(
    "J1_exclude_incidents", "request_id:s us:i",
    f"SELECT * FROM logs WHERE NOT ({CYCLE} >= 300 AND {CYCLE} < 480 OR {CYCLE} >= 720 AND {CYCLE} < 840 "
    f"OR {CYCLE} >= 1200 AND {CYCLE} < 1320)",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir).select("request_id", "us")
    return exclude_incidents(df, incidents_until(df, E.TRAINING_EXCLUSIONS))


SPAN_SQL = " ".join(f"WHEN us >= lo + (hi - lo) * {a} // 100 AND us < lo + (hi - lo) * {b} // 100 THEN '{name}'" for name, a, b in SPANS)


@query(
    "J2_tag_incidents", "request_id:s tag:s",
    f"ends AS (SELECT min(us) AS lo, max(us) AS hi FROM logs) => SELECT request_id, CASE {SPAN_SQL} ELSE '-' END AS tag FROM logs, ends",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir).select("request_id", "us")
    return tag_incidents(df, incidents(df), name="tag").fillna("-", subset=["tag"])


@query(
    "J3_bucket_spine", "bucket_us:i n:i",
    "spine AS (SELECT unnest(generate_series((SELECT min(us) - min(us) % 60000000 FROM logs) - 600000000, "
    "(SELECT max(us) FROM logs), 60000000)) AS bucket_us), "
    "per AS (SELECT us - us % 60000000 AS bucket_us, count(*) AS n FROM logs WHERE is_error GROUP BY 1) => "
    "SELECT s.bucket_us, coalesce(n, 0) AS n FROM spine s LEFT JOIN per p ON s.bucket_us = p.bucket_us",
    rates=FREQUENT,
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir, FREQUENT)
    ends = df.agg(F.min("us"), F.max("us")).first()
    per = df.filter("is_error").groupBy(X.epoch_bucket_us(F.col("us"), 60).alias("bucket_us")).agg(F.count("*").alias("n"))
    spine = bucket_spine(spark, F.lit(ends[0] - 600 * MICROS), F.lit(ends[1]), 60)
    return fill_spine(spine, per, ("n",))


# --- aggregations --------------------------------------------------------------------------------------------

RECENT_CTE = "w AS (SELECT * FROM logs ORDER BY us DESC, request_id LIMIT 1000), "
LEVEL_SQL = ", ".join(
    f"count(*) FILTER (log_level = '{x}') AS level_{x.lower()}, "
    f"round(count(*) FILTER (log_level = '{x}') / count(*) * 100, %d) AS level_{x.lower()}_pct"
    for x in ("INFO", "WARN", "ERROR", "CRITICAL")
)
LEVEL_COLUMNS = " ".join(f"level_{x}:i level_{x}_pct:d" for x in ("info", "warn", "error", "critical"))


def top_sql(k: int) -> str:
    return (
        "top AS (SELECT string_agg(concat(service_name, ':', n), ',' ORDER BY n DESC, service_name) AS top_services FROM "
        f"(SELECT service_name, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, service_name LIMIT {k})) => "
    )


@query(
    "A1_recent_stats",
    f"window_size:i total_in_table:i {LEVEL_COLUMNS} avg_response_ms:d p95_response_ms:d max_response_ms:d "
    "error_rate_pct:d slow_rate_pct:d top_services:s",
    RECENT_CTE + top_sql(5) + "SELECT count(*) AS window_size, (SELECT count(*) FROM logs) AS total_in_table, "
    + LEVEL_SQL % (2, 2, 2, 2) + ", round(avg(response_time_ms), 2) AS avg_response_ms, "
    "round(round(quantile_cont(response_time_ms, 0.95), 6), 2) AS p95_response_ms, max(response_time_ms) AS max_response_ms, "
    "round(count(*) FILTER (is_error) / count(*) * 100, 2) AS error_rate_pct, "
    "round(count(*) FILTER (is_slow) / count(*) * 100, 2) AS slow_rate_pct, any_value(top_services) AS top_services "
    "FROM w, top",
)
def _(spark, sf_dir):
    return G.recent_stats(logs(spark, sf_dir)).withColumn("top_services", listing("top_services", "service", "count"))


@query(
    "A2_level_distribution", "log_level:s n:i pct:d",
    "SELECT log_level, count(*) AS n, round(count(*) / (SELECT count(*) FROM logs) * 100, 2) AS pct FROM logs GROUP BY 1",
)
def _(spark, sf_dir):
    return G.level_distribution(logs(spark, sf_dir))


@query(
    "A3_percentile_by_service", "service_name:s value:d",
    "SELECT service_name, quantile_cont(response_time_ms, 0.95) AS value FROM logs GROUP BY 1",
)
def _(spark, sf_dir):
    return G.interpolated_percentile(logs(spark, sf_dir), "response_time_ms", 0.95, ("service_name",))


@query(
    "A3_percentile_real", "service_name:s value:d",
    "SELECT service_name, quantile_cont(CAST(response_time_ms AS DOUBLE) * 1.25 + CAST(seq AS DOUBLE) / 1000, 0.95) AS value FROM logs GROUP BY 1",
)
def _(spark, sf_dir):
    real = logs(spark, sf_dir).select("service_name", (F.col("response_time_ms") * 1.25 + F.col("seq") / 1000).alias("cost"))
    return G.interpolated_percentile(real, "cost", 0.95, ("service_name",))


@query(
    "A4_top_services", "service:s n:i pct:d",
    "SELECT service_name AS service, count(*) AS n, round(count(*) / (SELECT count(*) FROM logs) * 100, 2) AS pct "
    "FROM logs GROUP BY 1 ORDER BY n DESC, service LIMIT 3",
)
def _(spark, sf_dir):
    return G.top_services(logs(spark, sf_dir), 3)


@query(
    "A5_rolling_summary",
    f"window_size:i {LEVEL_COLUMNS} avg_response_ms:d p95_response_ms:d stddev_ms:d max_response_ms:i error_count:i "
    "error_rate_pct:d health:s top_services:s",
    RECENT_CTE + top_sql(3) + "SELECT count(*) AS window_size, " + LEVEL_SQL % (1, 1, 1, 1)
    + ", round(avg(response_time_ms), 1) AS avg_response_ms, "
    "round(round(quantile_cont(response_time_ms, 0.95), 6), 1) AS p95_response_ms, "
    "round(stddev_samp(response_time_ms), 1) AS stddev_ms, max(response_time_ms) AS max_response_ms, "
    "count(*) FILTER (is_error) AS error_count, round(count(*) FILTER (is_error) / count(*) * 100, 2) AS error_rate_pct, "
    "CASE WHEN count(*) FILTER (is_error) / count(*) * 100 < 2 THEN 'ok' "
    "WHEN count(*) FILTER (is_error) / count(*) * 100 < 8 THEN 'warn' ELSE 'bad' END AS health, "
    "any_value(top_services) AS top_services FROM w, top",
)
def _(spark, sf_dir):
    return G.rolling_summary(logs(spark, sf_dir)).withColumn("top_services", listing("top_services", "service", "count"))


@query(
    "A6_health_by_service", "service_name:s error_rate_pct:d health:s",
    "SELECT service_name, count(*) FILTER (is_error) / count(*) * 100 AS error_rate_pct, "
    "CASE WHEN count(*) FILTER (is_error) / count(*) * 100 < 2 THEN 'ok' "
    "WHEN count(*) FILTER (is_error) / count(*) * 100 < 8 THEN 'warn' ELSE 'bad' END AS health FROM logs GROUP BY 1",
)
def _(spark, sf_dir):
    rate = F.count_if("is_error") / F.count("*") * 100
    return logs(spark, sf_dir).groupBy("service_name").agg(rate.alias("error_rate_pct")).withColumn(
        "health", G.health_band(F.col("error_rate_pct"))
    )


SERVICE_COLUMNS = (
    "service:s total:i avg_response_ms:d error_count:i error_rate_pct:d level_info:i level_warn:i level_error:i "
    "level_critical:i"
)
SERVICE_SQL = (
    "SELECT service_name AS service, count(*) AS total, round(avg(response_time_ms), 1) AS avg_response_ms, "
    "count(*) FILTER (is_error) AS error_count, round(count(*) FILTER (is_error) / count(*) * 100, 2) AS error_rate_pct, "
    + ", ".join(f"count(*) FILTER (log_level = '{x}') AS level_{x.lower()}" for x in ("INFO", "WARN", "ERROR", "CRITICAL"))
    + " FROM %s GROUP BY 1 ORDER BY total DESC, service LIMIT 20"
)
LAST_HOUR = "h AS (SELECT logs.* FROM logs, now_ WHERE us BETWEEN now_us - 3600000000 AND now_us)"


@query("A7_service_levels", SERVICE_COLUMNS, SERVICE_SQL % "logs")
def service_levels_query(spark, sf_dir):
    return G.service_levels(logs(spark, sf_dir))


@query(
    "A8_timeline", "time:s timestamp_epoch:i total:i error_count:i anomaly_count:i avg_response_ms:d p95_response_ms:d",
    LAST_HOUR + ", spine AS (SELECT unnest(generate_series((now_us - 3600000000) - (now_us - 3600000000) % 300000000, "
    "now_us, 300000000)) AS bucket_us FROM now_), per AS (SELECT us - us % 300000000 AS bucket_us, count(*) AS total, "
    "count(*) FILTER (is_error) AS error_count, count(*) FILTER (is_anomaly) AS anomaly_count, "
    "round(avg(response_time_ms), 1) AS avg_response_ms, "
    "round(round(quantile_cont(response_time_ms, 0.95), 6), 1) AS p95_response_ms FROM h GROUP BY 1) => "
    "SELECT strftime(make_timestamp(s.bucket_us), '%H:%M') AS time, s.bucket_us // 1000 AS timestamp_epoch, "
    "coalesce(total, 0) AS total, coalesce(error_count, 0) AS error_count, coalesce(anomaly_count, 0) AS anomaly_count, "
    "coalesce(avg_response_ms, 0) AS avg_response_ms, coalesce(p95_response_ms, 0) AS p95_response_ms "
    "FROM spine s LEFT JOIN per p ON s.bucket_us = p.bucket_us",
    rates=FREQUENT,
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir, FREQUENT)
    return G.timeline(df, hours=1, as_of=S.latest_instant(df))


PROFILE_COLUMNS = "total_docs:i p50_ms:d p95_ms:d p99_ms:d min_ms:d max_ms:d avg_ms:d stddev_ms:d"
PROFILE_SQL = (
    "SELECT count(*) AS total_docs, round(round(quantile_cont(response_time_ms, 0.5), 6), 1) AS p50_ms, "
    "round(round(quantile_cont(response_time_ms, 0.95), 6), 1) AS p95_ms, round(round(quantile_cont(response_time_ms, 0.99), 6), 1) AS p99_ms, "
    "min(response_time_ms) AS min_ms, max(response_time_ms) AS max_ms, round(avg(response_time_ms), 1) AS avg_ms, "
    "round(stddev_pop(response_time_ms), 1) AS stddev_ms FROM %s"
)


@query("A9_latency_profile", PROFILE_COLUMNS, PROFILE_SQL % "logs WHERE service_name = 'click-1'")
def _(spark, sf_dir):
    return G.latency_profile(logs(spark, sf_dir), service="click-1")


@query(
    "A10_service_report", f"{SERVICE_COLUMNS} {PROFILE_COLUMNS}",
    f"{LAST_HOUR} => SELECT * FROM ({SERVICE_SQL % 'h'}), ({PROFILE_SQL % 'h'})",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir)
    return G.service_report(df, hours=1, as_of=S.latest_instant(df))


@query(
    "A11_anomalies_by_service",
    "service:s anomaly_count:i avg_anomaly_score:d total_anomalies:i pct_of_total:d worst_us:i worst_level:s "
    "worst_endpoint:s worst_ms:i worst_score:d worst_message:s",
    "r AS (SELECT logs.* FROM logs, now_ WHERE is_anomaly AND us >= now_us - 1800000000), "
    "g AS (SELECT service_name AS service, count(*) AS anomaly_count, round(avg(anomaly_score), 4) AS avg_anomaly_score "
    "FROM r GROUP BY 1), t AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY service_name "
    "ORDER BY anomaly_score DESC, us DESC, request_id DESC) = 1) => "
    "SELECT g.*, (SELECT count(*) FROM r) AS total_anomalies, "
    "round(anomaly_count / (SELECT count(*) FROM r) * 100, 1) AS pct_of_total, us AS worst_us, log_level AS worst_level, "
    "endpoint AS worst_endpoint, response_time_ms AS worst_ms, round(anomaly_score, 4) AS worst_score, "
    "substr(message, 1, 80) AS worst_message FROM g JOIN t ON service = service_name ORDER BY anomaly_count DESC, service LIMIT 10",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir)
    out = G.anomalies_by_service(df, S.latest_instant(df))
    return out.select(
        "*", F.unix_micros("worst_log.timestamp").alias("worst_us"), F.col("worst_log.log_level").alias("worst_level"),
        F.col("worst_log.endpoint").alias("worst_endpoint"), F.col("worst_log.response_ms").alias("worst_ms"),
        F.col("worst_log.score").alias("worst_score"), F.col("worst_log.message").alias("worst_message"),
    )


@query(
    "A12_anomaly_stats",
    "total_logs:i total_anomalies:i anomaly_rate_pct:d peak_bucket:s peak_count:i by_bucket:s top_services:s",
    LAST_HOUR + ", spine AS (SELECT unnest(generate_series((now_us - 3600000000) - (now_us - 3600000000) % 600000000, "
    "now_us, 600000000)) AS bucket_us FROM now_), per AS (SELECT us - us % 600000000 AS bucket_us, count(*) AS n FROM h "
    "WHERE is_anomaly GROUP BY 1), bk AS (SELECT s.bucket_us, strftime(make_timestamp(s.bucket_us), '%H:%M') AS t, "
    "coalesce(n, 0) AS n FROM spine s LEFT JOIN per p ON s.bucket_us = p.bucket_us), "
    "pk AS (SELECT t, n FROM bk ORDER BY n DESC, bucket_us LIMIT 1), top AS (SELECT service_name, count(*) AS n FROM h "
    "WHERE is_anomaly GROUP BY 1 ORDER BY n DESC, service_name LIMIT 5) => "
    "SELECT count(*) AS total_logs, count(*) FILTER (is_anomaly) AS total_anomalies, "
    "round(count(*) FILTER (is_anomaly) / count(*) * 100, 2) AS anomaly_rate_pct, (SELECT t FROM pk) AS peak_bucket, "
    "(SELECT n FROM pk) AS peak_count, (SELECT string_agg(concat(t, ':', n), ',' ORDER BY bucket_us) FROM bk) AS by_bucket, "
    "(SELECT string_agg(concat(service_name, ':', n), ',' ORDER BY n DESC, service_name) FROM top) AS top_services FROM h",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir)
    out = G.anomaly_stats(df, S.latest_instant(df))
    return out.withColumns(
        {
            "by_bucket": listing("by_bucket", "time", "count"),
            "top_services": listing("top_services", "service", "anomaly_count"),
        }
    )


@query(
    "A14_scoring_counters", "scored:i anomalies:i anomaly_rate:d unique_ips:i",
    "SELECT count(*) AS scored, count(*) FILTER (is_anomaly) AS anomalies, "
    "count(*) FILTER (is_anomaly) / count(*) AS anomaly_rate, count(DISTINCT ip_address) AS unique_ips FROM logs",
    rates=FREQUENT,
)
def _(spark, sf_dir):
    return G.scoring_counters(logs(spark, sf_dir, FREQUENT))


@query(
    "A16_requests_per_ip", "min_requests:i mean_requests:d max_requests:i unique_ips:i",
    "SELECT min(n) AS min_requests, round(avg(n), 4) AS mean_requests, max(n) AS max_requests, count(*) AS unique_ips "
    "FROM (SELECT ip_address, count(*) AS n FROM logs GROUP BY 1)",
)
def _(spark, sf_dir):
    return G.requests_per_ip(logs(spark, sf_dir))


@query(
    "A17_split_error_rates", "split:s n:i error_rate:d",
    "r AS (SELECT *, row_number() OVER (ORDER BY us, seq) AS rank FROM logs) => "
    "SELECT CASE WHEN rank <= floor((SELECT count(*) FROM logs) * 0.8) THEN 'train' ELSE 'test' END AS split, "
    "count(*) AS n, avg(CASE WHEN status_code >= 400 THEN 1.0 ELSE 0.0 END) AS error_rate FROM r GROUP BY 1",
)
def _(spark, sf_dir):
    return G.split_error_rates(temporal_split(Fe.base_features(narrow(spark, sf_dir))))


@query(
    "A19_partition_inventory", "log_date:s n:i first_us:i last_us:i age_days:i phase:s",
    "SELECT strftime(timestamp, '%Y-%m-%d') AS log_date, count(*) AS n, min(us) AS first_us, max(us) AS last_us, "
    "date_diff('day', min(timestamp)::DATE, DATE '2024-06-17') AS age_days, "
    "CASE WHEN date_diff('day', min(timestamp)::DATE, DATE '2024-06-17') > 7 THEN 'expired' "
    "WHEN date_diff('day', min(timestamp)::DATE, DATE '2024-06-17') >= 1 THEN 'warm' ELSE 'hot' END AS phase "
    "FROM logs GROUP BY 1",
)
def _(spark, sf_dir):
    out = G.partition_inventory(logs(spark, sf_dir), F.lit("2024-06-17 00:00:00").cast("timestamp"))
    return out.withColumns({"first_us": F.unix_micros("first_ts"), "last_us": F.unix_micros("last_ts")})


# --- ordered features ----------------------------------------------------------------------------------------

FEATURE_CTE = """base AS (SELECT *, CAST(greatest(response_time_ms, 0) AS DOUBLE) AS rt,
  CASE WHEN status_code >= 400 THEN 1 ELSE 0 END AS err FROM logs),
feat AS (SELECT seq, us, log_level, status_code, ip_address, rt AS response_time_ms,
  (rt - avg(rt) OVER ()) / stddev_samp(rt) OVER () AS response_time_zscore, CAST(err AS DOUBLE) AS is_error,
  CAST(level_int AS DOUBLE) AS log_level_int,
  avg(err) OVER (ORDER BY us RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) AS error_rate_5min,
  avg(rt) OVER (ORDER BY us RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) AS avg_response_5min,
  CAST(count(*) OVER (PARTITION BY ip_address) AS DOUBLE) AS request_count_per_ip,
  row_number() OVER (ORDER BY us, seq) AS rank FROM base)"""


@query(
    "F01_clean_latency", "request_id:s cleaned:d",
    "SELECT request_id, greatest(coalesce(TRY_CAST(CASE response_time_ms % 10 WHEN 0 THEN 'n/a' WHEN 1 THEN "
    "concat('-', response_time_ms) ELSE CAST(response_time_ms AS VARCHAR) END AS DOUBLE), 0), 0) AS cleaned FROM logs",
)
def _(spark, sf_dir):
    digit = F.col("response_time_ms") % 10
    text = F.col("response_time_ms").cast("string")
    dirty = F.when(digit == 0, "n/a").when(digit == 1, F.concat(F.lit("-"), text)).otherwise(text)
    return logs(spark, sf_dir).select("request_id", X.clean_response(dirty).alias("cleaned"))


@query(
    "F02_batch_features", "seq:i " + " ".join(f"{f}:d" for f in MODEL_FEATURES),
    FEATURE_CTE + " => SELECT * FROM feat",
)
def _(spark, sf_dir):
    return Fe.batch_features(narrow(spark, sf_dir))


@query("F02_batch_features_split", ENTRIES["F02_batch_features"].columns, ENTRIES["F02_batch_features"].sql)
def _(spark, sf_dir):
    return Fe.batch_features(narrow(spark, sf_dir), rows_per_bucket=FEW)


@query(
    "F02_dirty_input", "seq:i response_time_zscore:d is_error:d",
    "x AS (SELECT seq, CASE WHEN seq % 7 = 0 THEN 0 ELSE response_time_ms END AS rt, seq % 7 <> 0 AND status_code >= 400 AS e FROM logs) "
    "=> SELECT seq, (rt - avg(rt) OVER ()) / stddev_samp(rt) OVER () AS response_time_zscore, CAST(e AS DOUBLE) AS is_error FROM x",
)
def _(spark, sf_dir):
    """A latency or status of the text NaN counts as 0 and as 200."""
    bad = F.when(F.col("seq") % 7 == 0, F.lit("NaN"))
    columns = {c: F.coalesce(bad, F.col(c).cast("string")) for c in ("response_time_ms", "status_code")}
    return Fe.batch_features(narrow(spark, sf_dir).withColumns(columns))


@query(
    "F03_http_error_flag", "request_id:s is_http_error:i",
    "SELECT request_id, CASE WHEN status_code >= 400 THEN 1 ELSE 0 END AS is_http_error FROM logs",
)
def _(spark, sf_dir):
    return Fe.base_features(logs(spark, sf_dir))


@query(
    "F07_serving_features",
    "seq:i error_rate_5min:d avg_response_5min:d request_count_per_ip:i response_time_zscore:d window_size:i is_warm:b",
    "o AS (SELECT *, CASE WHEN status_code >= 400 THEN 1 ELSE 0 END AS err, row_number() OVER (ORDER BY us, seq) AS rn, "
    "row_number() OVER (PARTITION BY ip_address ORDER BY us, seq) AS ip_n FROM logs), "
    "r AS (SELECT *, least(rn, 100) AS n, sum(err) OVER w AS e, sum(response_time_ms) OVER w AS s FROM o "
    "WINDOW w AS (ORDER BY us, seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)) => "
    "SELECT seq, (e + (100 - n) * 0.05) / 100 AS error_rate_5min, (s + (100 - n) * 150.0) / 100 AS avg_response_5min, "
    "ip_n AS request_count_per_ip, (response_time_ms - 792.96) / (2101.42 + 1e-10) AS response_time_zscore, "
    "n AS window_size, n >= 100 AS is_warm FROM r",
)
def _(spark, sf_dir):
    return Fe.serving_features(narrow(spark, sf_dir))


@query("F07_serving_features_split", ENTRIES["F07_serving_features"].columns, ENTRIES["F07_serving_features"].sql)
def _(spark, sf_dir):
    return Fe.serving_features(narrow(spark, sf_dir), rows_per_bucket=FEW, rows_per_block=FEW)


@query(
    "F09_legacy_features",
    "seq:i response_time_ms:d status_code:d log_level_int:d error_rate_5min:d avg_response_5min:d hour_of_day:d",
    "r AS (SELECT *, row_number() OVER (ORDER BY us, seq) AS rn, sum(CASE WHEN is_error THEN 1 ELSE 0 END) OVER w AS e, "
    "sum(response_time_ms) OVER w AS s FROM logs WINDOW w AS (ORDER BY us, seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)) => "
    "SELECT seq, response_time_ms, status_code, level_int AS log_level_int, CASE WHEN rn < 100 THEN 0 ELSE e / 100.0 END AS "
    "error_rate_5min, CASE WHEN rn < 100 THEN 200 ELSE s / 100.0 END AS avg_response_5min, hour_of_day FROM r",
)
def _(spark, sf_dir):
    return Fe.legacy_features(narrow(spark, sf_dir))


@query(
    "F11_null_fill", "seq:i response_time_zscore:d error_rate_5min:d",
    "SELECT seq, 0.0 AS response_time_zscore, CASE WHEN is_slow THEN 0.0 ELSE anomaly_score END AS error_rate_5min FROM logs",
)
def _(spark, sf_dir):
    nothing = F.lit(None).cast("double")
    given = {f: nothing for f in MODEL_FEATURES}
    given["error_rate_5min"] = F.when(~F.col("is_slow"), F.col("anomaly_score"))
    return Fe.fill_missing(logs(spark, sf_dir).withColumns(given))


COUNT_CTE = (
    "c AS (SELECT *, count(*) OVER (ORDER BY us RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW) AS anomaly_count "
    "FROM logs WHERE is_anomaly)"
)


@query("F13_trailing_anomalies", "seq:i anomaly_count:i", COUNT_CTE + " => SELECT seq, anomaly_count FROM c")
def _(spark, sf_dir):
    return A.anomaly_counts(logs(spark, sf_dir).filter("is_anomaly").select("us", "seq"))


@query("F13_trailing_anomalies_split", ENTRIES["F13_trailing_anomalies"].columns, ENTRIES["F13_trailing_anomalies"].sql)
def _(spark, sf_dir):
    return A.anomaly_counts(logs(spark, sf_dir).filter("is_anomaly").select("us", "seq"), rows_per_bucket=FEW)


def _chain_sql(period_us: int, keys: str) -> str:
    """Follow each key from its first row to the next row at least one period later."""
    on = " AND ".join(f"n.{k} = f.{k}" for k in keys.split(", "))
    return (
        f"fired AS (SELECT {keys}, min(us) AS us FROM c GROUP BY {keys} UNION ALL "
        f"SELECT {', '.join('f.' + k for k in keys.split(', '))}, (SELECT min(n.us) FROM c n WHERE {on} "
        f"AND n.us >= f.us + {period_us}) AS us FROM fired f WHERE f.us IS NOT NULL)"
    )


ALERT_CTES = (
    COUNT_CTE.replace("c AS", "counted AS") + ", c AS MATERIALIZED (SELECT * FROM counted WHERE anomaly_count > 10), "
    + "tail AS (WITH RECURSIVE " + _chain_sql(30_000_000, "service_name") + " SELECT * FROM fired WHERE us IS NOT NULL)"
)


@query(
    "A18_alert_counters",
    "current_window_count:i window_seconds:i threshold_high:i threshold_critical:i total_anomalies:i "
    "total_alerts_fired:i alert_rate_current:d",
    ALERT_CTES + " => SELECT count(*) FILTER (us >= now_us - 60000000) AS current_window_count, 60 AS window_seconds, "
    "10 AS threshold_high, 25 AS threshold_critical, count(*) AS total_anomalies, "
    "(SELECT count(*) FROM tail) AS total_alerts_fired, "
    "round(count(*) FILTER (us >= now_us - 60000000) / 60 * 60, 1) AS alert_rate_current FROM logs, now_ WHERE is_anomaly",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir)
    return A.alert_counters(df, A.fire_alerts(df), S.latest_instant(df))


@query(
    "W3_alerts",
    "alert_id:s timestamp:s alert_type:s severity:s anomaly_count:i window_seconds:i rate_per_min:d threshold_used:i "
    "service_name:s sample_score:d sample_message:s",
    ALERT_CTES + " => SELECT concat('alt-', substr(md5(concat(c.service_name, '|HIGH_ANOMALY_RATE|', c.us)), 1, 8)) AS alert_id, "
    "strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp, 'HIGH_ANOMALY_RATE' AS alert_type, "
    "CASE WHEN anomaly_count > 25 THEN 'CRITICAL' ELSE 'HIGH' END AS severity, anomaly_count, 60 AS window_seconds, "
    "round(anomaly_count / 60 * 60, 1) AS rate_per_min, CASE WHEN anomaly_count > 25 THEN 25 ELSE 10 END AS threshold_used, "
    "c.service_name, round(anomaly_score, 4) AS sample_score, substr(message, 1, 120) AS sample_message "
    "FROM c JOIN tail t ON c.service_name = t.service_name AND c.us = t.us",
)
def _(spark, sf_dir):
    out = A.alerts(logs(spark, sf_dir))
    return out.select(
        "*", F.col("sample_log.service_name").alias("service_name"), F.col("sample_log.anomaly_score").alias("sample_score"),
        F.col("sample_log.message").alias("sample_message"),
    )


@query(
    "W5_notices", "request_id:s service_name:s log_level:s us:i",
    "c AS MATERIALIZED (SELECT * FROM logs WHERE is_anomaly), tail AS (WITH RECURSIVE "
    + _chain_sql(5_000_000, "service_name, log_level") + " SELECT * FROM fired WHERE us IS NOT NULL) => "
    "SELECT c.* FROM c JOIN tail t ON c.service_name = t.service_name AND c.log_level = t.log_level AND c.us = t.us",
)
def _(spark, sf_dir):
    return A.notices(logs(spark, sf_dir))


@query("W3_alerts_split", ENTRIES["W3_alerts"].columns, ENTRIES["W3_alerts"].sql)
def _(spark, sf_dir):
    out = A.build_alerts(A.fire_alerts(logs(spark, sf_dir), rows_per_bucket=FEW))
    return out.select(
        "*", F.col("sample_log.service_name").alias("service_name"), F.col("sample_log.anomaly_score").alias("sample_score"),
        F.col("sample_log.message").alias("sample_message"),
    )


@query("W5_notices_split", ENTRIES["W5_notices"].columns, ENTRIES["W5_notices"].sql)
def _(spark, sf_dir):
    return A.notices(logs(spark, sf_dir), rows_per_bucket=FEW)
