"""Search, paging and aggregations on hand-made rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.operators import aggregates as G
from emberlog.operators import search as S
from emberlog.operators.joins import Incident, exclude_incidents, tag_incidents

START = datetime(2024, 6, 15, 14, 0)
SCHEMA = (
    "timestamp timestamp, request_id string, log_level string, service_name string, endpoint string, response_time_ms int, "
    "status_code int, message string, is_error boolean, is_slow boolean, is_anomaly boolean, anomaly_score double"
)


def row(i, level="INFO", rt=100, service="a", status=200, at=None, anomaly=False, score=0.0):
    ts = at or START + timedelta(seconds=i)
    return (ts, f"r{i:04}", level, service, "/x", rt, status, "m" * 100, level in ("ERROR", "CRITICAL"), rt > 1000,
            anomaly, score)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("bad", [
    {"level": "VERBOSE"}, {"limit": 999}, {"limit": 0}, {"offset": -1}, {"min_response_ms": -1}, {"status_code": 99},
])
def test_search_rejects_bad_parameters(spark, bad):
    with pytest.raises(ValueError):
        S.search_logs(table(spark, [row(1)]), **bad)


@pytest.mark.parametrize("call", [
    lambda df: S.search_anomalies(df, limit=501), lambda df: S.recent_logs(df, 0), lambda df: S.recent_alerts(df, 101),
    lambda df: G.timeline(df, 25), lambda df: G.service_report(df, 0),
])
def test_other_bounds(spark, call):
    with pytest.raises(ValueError):
        call(table(spark, [row(1)]))


def test_search_combines_predicates_and_pages(spark):
    df = table(spark, [row(i, "ERROR" if i % 2 else "INFO", rt=i) for i in range(40)])
    page = S.search_logs(df, limit=5, offset=2, level="error", min_response_ms=3, max_response_ms=31)
    assert page.total() == 15
    assert [r.response_time_ms for r in page.rows.collect()] == [27, 25, 23, 21, 19]


def test_equal_instants_page_without_overlap(spark):
    df = table(spark, [row(i, at=START) for i in range(30)])
    seen = [r.request_id for o in range(0, 30, 10) for r in S.search_logs(df, limit=10, offset=o).rows.collect()]
    assert seen == sorted(seen) and len(set(seen)) == 30


def test_last_hour_includes_both_ends(spark):
    at = [START - timedelta(hours=1, microseconds=1), START - timedelta(hours=1), START, START + timedelta(microseconds=1)]
    df = table(spark, [row(i, at=t) for i, t in enumerate(at)])
    assert [r.request_id for r in S.in_last(df, START, hours=1).orderBy("request_id").collect()] == ["r0001", "r0002"]
    assert S.in_last(df, START, hours=1, open_end=True).count() == 3


def test_recent_stats_of_a_level_mix(spark):
    mix = [("INFO", 100)] * 80 + [("WARN", 800)] * 15 + [("ERROR", 5000)] * 4 + [("CRITICAL", 9800)]
    out = G.recent_stats(table(spark, [row(i, level, rt) for i, (level, rt) in enumerate(mix)])).first()
    assert (out.level_info, out.level_error, out.level_critical, out.window_size) == (80, 4, 1, 100)
    assert out.level_info_pct + out.level_warn_pct + out.level_error_pct + out.level_critical_pct == 100
    assert out.error_rate_pct == 5.0 and out.slow_rate_pct == 5.0 and out.max_response_ms == 9800


def test_recent_stats_take_the_newest_rows_only(spark):
    df = table(spark, [row(i, "ERROR" if i < 50 else "INFO") for i in range(150)])
    out = G.recent_stats(df, 100).first()
    assert (out.window_size, out.total_in_table, out.level_error) == (100, 150, 0)
    assert G.recent_stats(df.limit(0)).count() == 0


def test_unknown_and_missing_levels(spark):
    df = table(spark, [row(1, None), row(2, "INFO"), row(3, "TRACE"), row(4, "WARN")])
    got = {r.log_level: (r.n, r.pct) for r in G.level_distribution(df).collect()}
    assert got == {"INFO": (2, 50.0), "WARN": (1, 25.0), "ERROR": (0, 0.0), "CRITICAL": (0, 0.0)}


def test_percentile_interpolates(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "v int")
    assert G.interpolated_percentile(df, "v", 0.95).first().value == pytest.approx(8.95)


@pytest.mark.parametrize("rate,band", [(1.99, "ok"), (2.0, "warn"), (7.99, "warn"), (8.0, "bad")])
def test_health_band(spark, rate, band):
    assert spark.range(1).select(G.health_band(F.lit(rate)).alias("b")).first().b == band


def test_anomaly_stats_peak_and_rate(spark):
    rows = [row(i, at=START - timedelta(minutes=9), anomaly=i < 5) for i in range(250)]
    rows += [row(i + 250, at=START + timedelta(minutes=1), anomaly=i < 20, service="b") for i in range(250)]
    out = G.anomaly_stats(table(spark, rows), START + timedelta(minutes=9)).first()
    assert (out.total_anomalies, out.total_logs, out.anomaly_rate_pct) == (25, 500, 5.0)
    assert (out.peak_bucket, out.peak_count) == ("14:00", 20)
    assert [(b.time, b["count"]) for b in out.by_bucket if b["count"]] == [("13:50", 5), ("14:00", 20)]
    assert len(out.by_bucket) == 7
    assert [(s.service, s.anomaly_count) for s in out.top_services] == [("b", 20), ("a", 5)]


def test_anomaly_stats_earliest_peak_on_a_tie(spark):
    rows = [row(1, at=START, anomaly=True), row(2, at=START + timedelta(minutes=10), anomaly=True)]
    assert G.anomaly_stats(table(spark, rows), START + timedelta(minutes=15)).first().peak_bucket == "14:00"


def test_timeline_fills_empty_buckets(spark):
    df = table(spark, [row(1, rt=100), row(2, rt=300)])
    out = G.timeline(df, 1, START + timedelta(minutes=10)).orderBy("timestamp_epoch").collect()
    assert len(out) == 13 and [b.total for b in out if b.total] == [2]
    assert out[0].avg_response_ms == 0.0 and out[0].time == "13:10"


def test_approximate_profile_is_close(spark):
    df = table(spark, [row(i, rt=i) for i in range(1, 1001)])
    exact, near = G.latency_profile(df).first(), G.latency_profile(df, approximate=True).first()
    assert abs(exact.p95_ms - near.p95_ms) < 2 and exact.total_docs == near.total_docs == 1000
    assert exact.stddev_ms == pytest.approx(288.7, abs=0.05)


def test_worst_log_per_service(spark):
    df = table(spark, [row(i, anomaly=True, score=i / 10, rt=i) for i in range(5)])
    out = G.anomalies_by_service(df, START + timedelta(minutes=1)).first()
    assert out.anomaly_count == 5 and out.worst_log.response_ms == 4 and len(out.worst_log.message) == 80
    assert out.pct_of_total == 100.0


def test_inventory_phases(spark):
    days = [date(2024, 6, 20), date(2024, 6, 19), date(2024, 6, 1)]
    df = spark.createDataFrame([(d, datetime(d.year, d.month, d.day)) for d in days], "log_date date, timestamp timestamp")
    got = {r.log_date: r.phase for r in G.partition_inventory(df, datetime(2024, 6, 20, 5)).collect()}
    assert list(map(got.get, days)) == ["hot", "warm", "expired"]


def test_incident_ends_are_half_open(spark):
    df = spark.createDataFrame([(t,) for t in (99, 100, 199, 200)], "us long")
    spans = [Incident("x", 100, 200), Incident("y", 500, 600)]
    assert sorted(r.us for r in exclude_incidents(df, spans).collect()) == [99, 200]
    assert {r.us: r.incident for r in tag_incidents(df, spans).collect()} == {99: None, 100: "x", 199: "x", 200: None}
    with pytest.raises(ValueError):
        tag_incidents(df, [Incident("x", 0, 10), Incident("y", 5, 20)])


def test_rule_flag_handles_null(spark):
    df = spark.createDataFrame([(90.0,), (90.5,), (None,)], "value double")
    assert [r.is_anomaly for r in S.over_threshold(df, "value").collect()] == [False, True, False]


@pytest.mark.parametrize("name", ["top_services", "service_report", "anomalies_by_service", "anomaly_stats"])
def test_several_groupings_read_the_table_once(spark, tmp_path, name):
    """Groups and totals are grouping sets of one scan."""
    rows = [(datetime(2024, 6, 15, 9, i % 60), f"r{i}", "ERROR" if i % 4 else "INFO", f"s{i % 3}", 10 * i, i % 4 > 0, i % 5 == 0, i / 9, "/e", "m") for i in range(100)]
    schema = "timestamp timestamp, request_id string, log_level string, service_name string, response_time_ms int, is_error boolean, is_anomaly boolean, anomaly_score double, endpoint string, message string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = getattr(G, name)(df) if name == "top_services" else getattr(G, name)(df, as_of=datetime(2024, 6, 15, 9, 59))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and out.count() > 0


def test_several_groupings_of_no_rows(spark):
    schema = "timestamp timestamp, request_id string, log_level string, service_name string, response_time_ms int, is_error boolean, is_anomaly boolean, anomaly_score double, endpoint string, message string"
    none, at = spark.createDataFrame([], schema), datetime(2024, 6, 15, 9, 59)
    assert G.top_services(none).count() == G.service_report(none, as_of=at).count() == G.anomalies_by_service(none, as_of=at).count() == 0
    row = G.anomaly_stats(none, as_of=at).first()
    assert (row.total_logs, row.total_anomalies, row.peak_count, len(row.by_bucket), row.top_services) == (0, 0, 0, 7, [])
