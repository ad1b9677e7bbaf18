"""Registered queries on raw messages: every log row as JSON, with a cycle of planted faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators import parsing as P
from emberlog.plans.catalog import query
from emberlog.sources import documents as D
from emberlog.sources.fixture import log_table

_ISO = {"spark": "date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
        "duck": "strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f')"}

# Position in the cycle, the JSON field it changes, and the replacement (None leaves the field out).
FAULTS = (
    (5, "timestamp", None), (6, "log_level", None), (7, "service_name", None), (8, "endpoint", None),
    (9, "response_time_ms", None), (10, "status_code", None), (11, "user_id", None), (12, "ip_address", None),
    (13, "message", None), (14, "timestamp", "1718442000"), (15, "response_time_ms", '"12"'),
    (16, "status_code", "true"), (17, "status_code", '"200"'), (18, "user_id", "null"),
    (19, "response_time_ms", "5200.0"), (20, "response_time_ms", "1.5e2"), (21, "response_time_ms", "-0.5"),
    (22, "response_time_ms", "-1"), (23, "response_time_ms", "5200.9"), (24, "status_code", "99"),
    (25, "status_code", "100"), (26, "status_code", "599"), (27, "status_code", "600"), (28, "log_level", '"info"'),
    (29, "log_level", '"DEBUG"'), (30, "timestamp", '"   "'), (31, "timestamp", '"2024-06-15T09:00:01.5Z"'),
    (32, "timestamp", '"2024-06-15T11:00:01+02:00"'), (33, "timestamp", '"2024-06-15T09:00:01.250"'),
    (34, "timestamp", '"  2024-06-15T09:00:02+00:00 "'), (35, "timestamp", '"2024-06-15"'),
    (36, "timestamp", '"yesterday"'), (37, "timestamp", '"2024"'), (38, "endpoint", None), (38, "status_code", '"x"'),
    (39, "service_name", "17"), (39, "log_level", '"TRACE"'),
)
CYCLE = 45


def _field(name: str, value: str) -> str:
    cases = "".join(
        f" WHEN {at} THEN " + ("''" if text is None else f"'\"{name}\":{text},'")
        for at, field, text in FAULTS if field == name
    )
    plain = f"concat('\"{name}\":', {value}, ',')"
    return f"CASE seq % {CYCLE}{cases} ELSE {plain} END" if cases else plain


def raw_body(engine: str) -> str:
    """SQL text of the message body."""
    kind = "STRING" if engine == "spark" else "VARCHAR"

    def text(column: str) -> str:
        return f"concat('\"', {column}, '\"')"

    stamp = f"concat('\"', {_ISO[engine]}, '+00:00\"')"
    fields = [
        _field("timestamp", stamp), _field("log_level", text("log_level")), _field("service_name", text("service_name")),
        _field("endpoint", text("endpoint")), _field("response_time_ms", f"CAST(response_time_ms AS {kind})"),
        _field("status_code", f"CAST(status_code AS {kind})"), _field("user_id", text("user_id")),
        _field("ip_address", text("ip_address")), _field("message", text("message")),
    ]
    extra = f"CASE seq % {CYCLE} WHEN 41 THEN '\"shard\":7,\"zone\":\"b\",' ELSE '' END"
    whole = f"concat('{{', {', '.join(fields)}, {extra}, '\"request_id\":\"', request_id, '\"}}')"
    return (
        f"CASE seq % {CYCLE} WHEN 0 THEN 'not utf-8' WHEN 1 THEN '{{broken' WHEN 2 THEN '[1, 2]' WHEN 3 THEN '17' "
        f"WHEN 4 THEN 'null' ELSE {whole} END"
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq, key, value``: one message per log row."""
    body = log_table(spark, sf_dir).selectExpr("seq", "service_name AS key", f"{raw_body('spark')} AS body")
    value = F.when(F.col("seq") % CYCLE == 0, F.unhex(F.lit("FFFE7B7D"))).otherwise(F.encode("body", "utf-8"))
    return body.select("seq", "key", value.alias("value"))


def _type(name: str) -> str:
    return f"json_type(j, '$.{name}')"


_STRINGS = ("timestamp", "log_level", "service_name", "endpoint")
_TAIL = ("user_id", "ip_address", "message")


def _string_checks(names) -> str:
    return "".join(
        f"WHEN {_type(n)} IS NULL THEN 'missing:{n}' WHEN {_type(n)} <> 'VARCHAR' THEN 'type:{n}' " for n in names
    )


PARSE_CTE = f"""m AS (SELECT seq, request_id, {raw_body('duck')} AS body FROM logs),
v AS (SELECT *, CASE WHEN seq % {CYCLE} <> 0 AND json_valid(body) AND body <> 'null' THEN body::JSON END AS j FROM m),
t AS (SELECT *, TRY_CAST(trunc(TRY_CAST(j->>'$.response_time_ms' AS DOUBLE)) AS INT) AS rt,
  TRY_CAST(j->>'$.status_code' AS INT) AS sc, trim(j->>'$.timestamp') AS ts_text FROM v),
u AS (SELECT *, CASE WHEN regexp_matches(ts_text, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN
  epoch_us(TRY_CAST(CASE WHEN length(ts_text) = 10 THEN concat(ts_text, ' 00:00:00+00:00')
    WHEN regexp_matches(ts_text, '(Z|[+-]\\d\\d:\\d\\d)$') THEN ts_text ELSE concat(ts_text, '+00:00') END AS TIMESTAMPTZ)) END AS us,
  CASE WHEN j IS NULL THEN NULL {_string_checks(_STRINGS)}
  WHEN {_type('response_time_ms')} IS NULL THEN 'missing:response_time_ms'
  WHEN {_type('response_time_ms')} NOT IN ('BIGINT','UBIGINT','DOUBLE') THEN 'type:response_time_ms'
  WHEN {_type('status_code')} IS NULL THEN 'missing:status_code'
  WHEN {_type('status_code')} NOT IN ('BIGINT','UBIGINT') THEN 'type:status_code' {_string_checks(_TAIL)}
  WHEN j->>'$.log_level' NOT IN ('INFO','WARN','ERROR','CRITICAL') THEN 'range:log_level'
  WHEN rt < 0 THEN 'range:response_time_ms' WHEN sc NOT BETWEEN 100 AND 599 THEN 'range:status_code'
  WHEN ts_text = '' THEN 'range:timestamp' END AS failure FROM t),
parsed AS (SELECT *, CASE WHEN j IS NULL THEN 'decode' WHEN failure IS NOT NULL THEN 'validate'
  WHEN us IS NULL THEN 'timestamp' ELSE 'ok' END AS stage,
  CASE WHEN j IS NULL THEN 'decode' WHEN failure IS NOT NULL THEN failure WHEN us IS NULL THEN 'timestamp' ELSE 'ok' END
  AS reason FROM u)"""


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.parse_logs(raw_messages(spark, sf_dir))
    return out.withColumns(
        {
            "stage": F.coalesce("reject_stage", F.lit("ok")), "reason": F.coalesce("reject_reason", F.lit("ok")),
            "us": F.unix_micros("timestamp"),
        }
    )


@query("P01_decode", "seq:i decoded:b", PARSE_CTE + " => SELECT seq, j IS NOT NULL AS decoded FROM parsed")
def _(spark, sf_dir):
    return P.decode(raw_messages(spark, sf_dir)).withColumn("decoded", F.col("document").isNotNull())


@query(
    "P02_presence", "seq:i reason:s",
    PARSE_CTE + " => SELECT seq, reason FROM parsed WHERE reason LIKE 'missing:%'",
)
def _(spark, sf_dir):
    return parsed(spark, sf_dir).filter(F.col("reason").startswith("missing:"))


@query("P03_types", "seq:i reason:s", PARSE_CTE + " => SELECT seq, reason FROM parsed WHERE reason LIKE 'type:%'")
def _(spark, sf_dir):
    return parsed(spark, sf_dir).filter(F.col("reason").startswith("type:"))


@query(
    "P04_latency_coercion", "seq:i response_time_ms:i",
    PARSE_CTE + " => SELECT seq, rt AS response_time_ms FROM parsed WHERE stage = 'ok'",
)
def _(spark, sf_dir):
    return parsed(spark, sf_dir).filter("stage = 'ok'")


@query("P05_ranges", "seq:i reason:s", PARSE_CTE + " => SELECT seq, reason FROM parsed WHERE reason LIKE 'range:%'")
def _(spark, sf_dir):
    return parsed(spark, sf_dir).filter(F.col("reason").startswith("range:"))


@query("P06_reject_reasons", "reason:s n:i", PARSE_CTE + " => SELECT reason, count(*) AS n FROM parsed GROUP BY 1")
def _(spark, sf_dir):
    return parsed(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n"))


@query("P07_timestamps", "seq:i us:i", PARSE_CTE + " => SELECT seq, us FROM parsed WHERE stage = 'ok'")
def _(spark, sf_dir):
    return parsed(spark, sf_dir).filter("stage = 'ok'")


@query(
    "P18_pipeline",
    "seq:i stage:s reason:s us:i log_level:s service_name:s endpoint:s response_time_ms:i status_code:i user_id:s "
    "ip_address:s message:s request_id:s",
    PARSE_CTE + " => SELECT seq, stage, reason, CASE WHEN stage = 'ok' THEN us END AS us, "
    + ", ".join(
        f"CASE WHEN stage = 'ok' THEN j->>'$.{n}' END AS {n}"
        for n in ("log_level", "service_name", "endpoint", "user_id", "ip_address", "message", "request_id")
    )
    + ", CASE WHEN stage = 'ok' THEN rt END AS response_time_ms, CASE WHEN stage = 'ok' THEN sc END AS status_code FROM parsed",
)
def _(spark, sf_dir):
    df = parsed(spark, sf_dir)
    fields = (
        "us", "log_level", "service_name", "endpoint", "response_time_ms", "status_code", "user_id", "ip_address",
        "message", "request_id",
    )
    return df.select("seq", "stage", "reason", *[F.when(F.col("stage") == "ok", F.col(c)).alias(c) for c in fields])


@query(
    "A13_pipeline_counters", "received:i processed:i skipped_decode:i skipped_validate:i skipped_timestamp:i",
    PARSE_CTE + " => SELECT count(*) AS received, count(*) FILTER (stage = 'ok') AS processed, "
    "count(*) FILTER (stage = 'decode') AS skipped_decode, count(*) FILTER (stage = 'validate') AS skipped_validate, "
    "count(*) FILTER (stage = 'timestamp') AS skipped_timestamp FROM parsed",
)
def _(spark, sf_dir):
    return P.pipeline_counters(P.parse_logs(raw_messages(spark, sf_dir)))


@query(
    "S06_strict_schema", "seq:i rejected_keys:s",
    PARSE_CTE + f" => SELECT seq, CASE WHEN seq % {CYCLE} = 41 THEN 'shard,zone' ELSE '' END AS rejected_keys "
    "FROM parsed WHERE stage = 'ok'",
)
def _(spark, sf_dir):
    fits, misfits = D.strict_split(P.parse_logs(raw_messages(spark, sf_dir)).filter("reject_stage IS NULL"))
    odd = misfits.select("seq", F.array_join(F.array_sort("rejected_keys"), ",").alias("rejected_keys"))
    return fits.select("seq", F.lit("").alias("rejected_keys")).unionByName(odd)


@query(
    "P22_recent_log_json", "request_id:s log_level:s status_code:i is_error:b",
    "SELECT request_id, log_level, status_code, is_error FROM logs WHERE seq % 10 > 1",
)
def _(spark, sf_dir):
    df = log_table(spark, sf_dir)
    spoiled = df.withColumn("log_level", F.when(F.col("seq") % 10 == 1, "VERBOSE").otherwise(F.col("log_level")))
    body = spoiled.select("seq", D.document(spoiled, skip=("seq", "us")).alias("body"))
    value = F.when(F.col("seq") % 10 == 0, F.lit("{broken")).otherwise(F.col("body"))
    return P.parse_recent(body.select(value.alias("value")))


@query(
    "P21_alert_json",
    "alert_id:s severity:s anomaly_count:i window_seconds:i rate_per_min:d threshold_used:i service_name:s response_time_ms:i",
    "SELECT CASE WHEN seq % 10 = 2 THEN 'unknown' ELSE request_id END AS alert_id, "
    "CASE WHEN seq % 10 = 3 THEN 'HIGH' ELSE 'CRITICAL' END AS severity, CASE WHEN seq % 10 = 3 THEN 0 ELSE "
    "response_time_ms END AS anomaly_count, 60 AS window_seconds, 1.5 AS rate_per_min, 10 AS threshold_used, service_name, "
    "response_time_ms FROM logs WHERE seq % 10 NOT IN (0, 1)",
)
def _(spark, sf_dir):
    value = F.expr(
        "CASE WHEN seq % 10 = 0 THEN '{broken' WHEN seq % 10 = 1 THEN '[]' ELSE concat('{', "
        "CASE WHEN seq % 10 = 2 THEN '' ELSE concat('\"alert_id\":\"', request_id, '\",') END, "
        "CASE WHEN seq % 10 = 3 THEN '' ELSE concat('\"severity\":\"CRITICAL\",\"anomaly_count\":', "
        "CAST(response_time_ms AS STRING), ',') END, '\"rate_per_min\":1.5,\"sample_log\":{\"service_name\":\"', service_name, "
        "'\",\"response_time_ms\":', CAST(response_time_ms AS STRING), '}}') END"
    )
    out = P.parse_alerts(log_table(spark, sf_dir).select(value.alias("value")))
    return out.select(
        "*", F.col("sample_log.service_name").alias("service_name"),
        F.col("sample_log.response_time_ms").alias("response_time_ms"),
    )


@query(
    "S07_json_document", "request_id:s iso:s status_code:i internal:i",
    "SELECT request_id, strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso, status_code, 0 AS internal FROM logs",
)
def _(spark, sf_dir):
    df = P.numeric_features(P.enrich(log_table(spark, sf_dir)))
    body = df.select(D.document(df).alias("body"))
    return body.select(
        F.get_json_object("body", "$.request_id").alias("request_id"), F.get_json_object("body", "$.timestamp").alias("iso"),
        F.get_json_object("body", "$.status_code").alias("status_code"),
        F.size(F.array_intersect(F.json_object_keys("body"), F.array(F.lit("features"), F.lit("consumed_at")))).alias("internal"),
    )


@query(
    "S12_live_feed", "request_id:s type:s is_anomaly:b anomaly_score:d",
    "SELECT request_id, CASE WHEN is_slow THEN 'slow' WHEN is_anomaly AND NOT is_error THEN 'anomaly' ELSE 'log' END AS type, "
    "is_anomaly AND NOT is_error AS is_anomaly, CASE WHEN is_error THEN 0 ELSE anomaly_score END AS anomaly_score FROM logs",
)
def _(spark, sf_dir):
    df = log_table(spark, sf_dir).withColumns(
        {
            "type": F.when(F.col("is_slow"), "slow"),
            "is_anomaly": F.when(~F.col("is_error"), F.col("is_anomaly")),
            "anomaly_score": F.when(~F.col("is_error"), F.col("anomaly_score")),
        }
    )
    fed = D.live_feed(df).select("payload")
    return fed.select(*[F.get_json_object("payload", f"$.{c}").alias(c) for c in ("request_id", "type", "is_anomaly", "anomaly_score")])


@query(
    "S11_keyed_messages", "key:s n:i bytes_min:i",
    "SELECT service_name AS key, count(*) AS n, 1 AS bytes_min FROM logs GROUP BY 1",
)
def _(spark, sf_dir):
    messages = D.keyed_messages(log_table(spark, sf_dir))
    return messages.groupBy("key").agg(F.count("*").alias("n"), F.min(F.least(F.length("value"), F.lit(1))).alias("bytes_min"))
