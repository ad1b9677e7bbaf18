"""Decode, validate and enrich on hand-made messages."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from emberlog.operators import parsing as P
from emberlog.sources.documents import strict_split

GOOD = {
    "timestamp": "2024-06-15T04:11:09.123+00:00", "log_level": "ERROR", "service_name": "checkout",
    "endpoint": "/checkout/item/3", "response_time_ms": 5200, "status_code": 503, "user_id": "guest",
    "ip_address": "192.168.0.7", "message": "boom",
}


def message(**changes):
    body = {**GOOD, **changes}
    return json.dumps({k: v for k, v in body.items() if v != "<gone>"}).encode()


def raw(text):
    return json.dumps(GOOD).replace("5200", text).encode()


CASES = [
    (message(), None), (b"\xff\xfe{}", "decode"), (b"{broken", "decode"), (b"null", "decode"), (b"", "decode"),
    (b"[1]", "missing:timestamp"), (b"17", "missing:timestamp"), (b'"text"', "missing:timestamp"),
    (raw("NaN"), "decode"), (b'{"a":1,"a":2}', "decode"),
    (json.dumps({"timestamp": "x", "level": "INFO", "service": "s", "latency_ms": 3, "index": 1}).encode(), "missing:log_level"),
    *[(message(**{f: "<gone>"}), f"missing:{f}") for f in GOOD],
    *[(message(**{f: None}), f"type:{f}") for f in GOOD],
    (message(status_code="200"), "type:status_code"), (message(status_code=True), "type:status_code"),
    (message(status_code=200.0), "type:status_code"), (message(user_id=7), "type:user_id"),
    (message(response_time_ms="12"), "type:response_time_ms"), (message(response_time_ms=True), "type:response_time_ms"),
    (raw("5200.0"), None), (raw("1.5e2"), None), (raw("-0.5"), None), (raw("5200.9"), None),
    (raw("-1"), "range:response_time_ms"), (raw("1e400"), "type:response_time_ms"),
    (raw("99999999999999"), "type:response_time_ms"),
    (message(status_code=99), "range:status_code"), (message(status_code=100), None), (message(status_code=599), None),
    (message(status_code=600), "range:status_code"), (message(log_level="info"), "range:log_level"),
    (message(log_level="DEBUG"), "range:log_level"), (message(timestamp="   "), "range:timestamp"),
    (message(timestamp="yesterday"), "timestamp"), (message(timestamp="2024"), "timestamp"),
    (message(timestamp="2024-13-45"), "timestamp"), (message(timestamp="2024-06-15 UTC"), "timestamp"),
    (message(timestamp="2024-06-15"), None), (message(timestamp=" 2024-06-15T14:30:00Z "), None),
    (message(timestamp="2024-06-15T14:30:00"), None), (message(timestamp="2024-06-15T16:30:00+0200"), None),
    (message(endpoint="<gone>", log_level="TRACE", status_code="x"), "missing:endpoint"),
    (message(log_level="TRACE", response_time_ms=-5, status_code=1), "range:log_level"),
    (message(shard=7), None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, bytearray(b)) for i, (b, _) in enumerate(CASES)], "i int, value binary")
    return P.parse_logs(df)


def test_first_failing_check_is_reported(parsed):
    got = {r.i: r.reject_reason for r in parsed.select("i", "reject_reason").collect()}
    wrong = [(CASES[i][0], got[i], want) for i, (_, want) in enumerate(CASES) if got[i] != want]
    assert not wrong


def test_filtering_gives_the_same_rows(parsed):
    good = {i for i, (_, want) in enumerate(CASES) if want is None}
    assert {r.i for r in P.valid_logs(parsed).select("i").collect()} == good
    assert P.dead_letters(parsed).count() == len(CASES) - len(good)


def test_counters(parsed):
    row = P.pipeline_counters(parsed).first()
    assert row.received == len(CASES) == row.processed + row.skipped_decode + row.skipped_validate + row.skipped_timestamp
    assert row.skipped_timestamp == 4


def test_latency_is_truncated_and_instants_are_utc(parsed):
    rows = {CASES[r.i][0]: r for r in P.valid_logs(parsed).withColumn("us", F.unix_micros("timestamp")).collect()}
    assert rows[raw("5200.9")].response_time_ms == 5200
    assert rows[raw("1.5e2")].response_time_ms == 150
    assert rows[raw("-0.5")].response_time_ms == 0
    half_past = int((datetime(2024, 6, 15, 14, 30) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    for text in (" 2024-06-15T14:30:00Z ", "2024-06-15T14:30:00", "2024-06-15T16:30:00+0200"):
        assert rows[message(timestamp=text)].us == half_past


def test_derived_fields(parsed):
    row = P.valid_logs(parsed).filter("i = 0").first()
    assert (row.level_int, row.is_error, row.is_slow, row.status_class, row.is_server_error) == (2, True, True, 5, True)
    assert (row.hour_of_day, row.day_of_week, row.endpoint_depth) == (4, 5, 3)
    assert row.features.response_time_ms == 5200.0 and row.features.is_error == 1.0


def test_json_is_parsed_once_per_row(parsed):
    plan = P.valid_logs(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_undeclared_keys_are_set_apart(parsed):
    fits, misfits = strict_split(parsed.filter("reject_stage IS NULL"))
    assert [r.rejected_keys for r in misfits.select("rejected_keys").collect()] == [["shard"]]
    assert fits.count() == sum(want is None for _, want in CASES) - 1


def test_alert_json_defaults_and_corrupt_entries(spark):
    values = ['{"alert_id":"a","severity":"CRITICAL","anomaly_count":12,"sample_log":{"service_name":"s"}}', "{oops", "{}",
              '{"anomaly_count":"many"}', "[]"]
    rows = P.parse_alerts(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    assert [(r.alert_id, r.severity, r.anomaly_count, r.window_seconds, r.threshold_used) for r in rows] == [
        ("a", "CRITICAL", 12, 60, 10), ("unknown", "HIGH", 0, 60, 10)]
    assert rows[0].sample_log.service_name == "s" and rows[1].sample_log.service_name is None


def test_recent_json_skips_corrupt_and_unknown_levels(spark):
    values = ['{"log_level":"INFO","status_code":200}', "{oops", '{"log_level":"VERBOSE"}', '{"status_code":500}']
    rows = P.parse_recent(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    assert [(r.log_level, r.status_code) for r in rows] == [("INFO", 200), (None, 500)]


def test_sample_message_is_cut_at_120(spark):
    df = spark.sql(
        "SELECT timestamp'2024-06-15 09:00:00' AS timestamp, 's' AS service_name, 'ERROR' AS log_level, '/x' AS endpoint, 5 AS "
        "response_time_ms, 500 AS status_code, 0.123456D AS anomaly_score, repeat('m', 300) AS message"
    )
    row = df.select(P.sample_log().alias("s")).first().s
    assert len(row.message) == 120 and row.anomaly_score == 0.1235


def test_only_the_fields_asked_for_are_read(parsed):
    """The counts by reason need the checks and the instant, not the other typed fields."""
    plan = parsed.groupBy("reject_reason").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "$.status_code" in plan
    assert not [f for f in ("request_id", "host", "stack_trace", "queue_depth") if f"$.{f}" in plan]


@pytest.mark.parametrize("text", [
    "2024-06-15T14:30:00+00:00", "2024-06-15 14:30:00.5Z", "2024-06-15T14:30:00.123456789-03:30", "2024-06-15T14:30:00\n", "2024-06-15T24:30:00Z",
    "2024-06-15T14:30:00+0200", "\t2024-06-15", "2024-06-15T14Z", "2024-02-30T00:00:00Z", "2024-06-15T14:30:00+25:00", "",
])
def test_plain_instants_read_like_mended_ones(spark, text):
    """White space in front leads round the short way for the usual form."""
    from emberlog.functions import scalar as X

    df = spark.createDataFrame([(text, " " + text)], "a string, b string")
    a, b = df.select(X.parse_iso(F.col("a")).cast("string"), X.parse_iso(F.col("b")).cast("string")).first()
    assert a == b
