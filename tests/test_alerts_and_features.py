"""Alerts, deduplication and features on hand-made rows."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators import alerts as A
from emberlog.operators import features as Fe
from emberlog.operators.dedupe import keep_latest, newest_distinct
from emberlog.streaming.alerting import AlertState, alert_batch
from emberlog.streaming.scoring import ScoringState, serving_batch

START = datetime(2024, 6, 15, 9, 0)
SCHEMA = (
    "us long, seq long, timestamp timestamp, service_name string, log_level string, endpoint string, response_time_ms int, "
    "status_code int, message string, ip_address string, anomaly_score double, is_anomaly boolean"
)


def anomalies(spark, seconds, service="checkout"):
    rows = []
    for i, s in enumerate(seconds):
        ts = START + timedelta(seconds=s)
        us = int((ts - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        rows.append((us, i, ts, service, "ERROR", "/x", 10, 500, "m", "1.1.1.1", 0.5, True))
    return spark.createDataFrame(rows, SCHEMA)


def test_threshold_is_strict(spark):
    assert A.alerts(anomalies(spark, range(10))).count() == 0
    fired = A.alerts(anomalies(spark, range(11))).collect()
    assert [(a.severity, a.anomaly_count, a.threshold_used, a.rate_per_min) for a in fired] == [("HIGH", 11, 10, 11.0)]


def test_critical_above_25_and_cooldown(spark):
    fired = A.alerts(anomalies(spark, [i * 0.1 for i in range(40)] + [31.5])).orderBy("timestamp").collect()
    assert [(a.severity, a.anomaly_count) for a in fired] == [("HIGH", 11), ("CRITICAL", 41)]
    assert fired[1].sample_log.service_name == "checkout"


def test_window_counts_fresh_rows_only(spark):
    df = anomalies(spark, [0] * 5 + [120, 120.5, 121])
    assert A.anomaly_counts(df).agg(F.max(F.struct("us", "anomaly_count")).alias("m")).first().m.anomaly_count == 3


def test_window_is_closed_at_60_seconds(spark):
    got = {r.seq: r.anomaly_count for r in A.anomaly_counts(anomalies(spark, [0, 60, 60.000001])).collect()}
    assert got == {0: 1, 1: 2, 2: 2}


def test_count_per_service_is_an_option(spark):
    df = anomalies(spark, range(8)).unionByName(anomalies(spark, range(8), "gateway").withColumn("seq", F.col("seq") + 100))
    assert A.alerts(df).count() == 2 and A.alerts(df, scope="service").count() == 0
    with pytest.raises(ValueError):
        A.anomaly_counts(df, scope="host")


def test_streamed_alerts_with_late_rows(spark, tmp_path):
    state = AlertState(spark, str(tmp_path))
    whole = anomalies(spark, [i * 2 for i in range(60)])
    parts = [whole.filter("seq < 25"), whole.filter("seq >= 25")]
    late = anomalies(spark, [-500]).withColumn("seq", F.lit(999).cast("bigint"))
    got = []
    for i, part in enumerate([parts[0], parts[1].unionByName(late)]):
        alert_batch(part, i, state, tie="seq").collect()
        got += alert_batch(part, i, state, tie="seq").select("alert_id", "anomaly_count").collect()
    want = A.alerts(whole).select("alert_id", "anomaly_count").collect()
    assert sorted(got) == sorted(want)
    assert state.clock.read().first().late_rows == 1


def history(spark):
    rows = [("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", 1, "only"), ("", 1, "x"), ("", 1, "x"), (None, 1, "y")]
    return spark.createDataFrame(rows, "request_id string, timestamp long, v string")


def test_keep_latest(spark):
    got = sorted((r.request_id or "", r.v) for r in keep_latest(history(spark)).collect())
    assert got == [("", "x"), ("", "x"), ("", "y"), ("a", "new"), ("b", "only")]


def test_keep_latest_of_identical_copies(spark):
    df = spark.range(300).select(F.lit("same").alias("request_id"), F.lit(1).alias("timestamp"))
    assert keep_latest(df).count() == 1


def test_keep_latest_without_a_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert keep_latest(history(spark)).count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_newest_distinct_collapses_equal_rows(spark):
    got = [(r.request_id or "", r.v) for r in newest_distinct(history(spark), 10).collect()]
    assert sorted(got) == [("", "x"), ("", "y"), ("a", "new"), ("b", "only")]


def log_rows(n=260, seed=5):
    rng = np.random.default_rng(seed)
    us = np.sort(rng.integers(0, 900_000_000, n))
    us[10:60] = us[10]
    status = rng.choice([200, 404, 500], n)
    return pd.DataFrame(
        {
            "us": us, "seq": np.arange(n), "timestamp": pd.to_datetime(us, unit="us"), "service_name": "s",
            "log_level": rng.choice(["INFO", "WARN", "ERROR"], n), "endpoint": "/x",
            "response_time_ms": rng.integers(1, 3000, n).astype("int32"), "status_code": status.astype("int32"), "message": "m",
            "ip_address": np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n)), "anomaly_score": 0.0,
            "is_anomaly": False,
        }
    )


def test_batch_features_equal_pandas(spark):
    pdf = log_rows()
    got = Fe.batch_features(spark.createDataFrame(pdf, SCHEMA), rows_per_bucket=50).toPandas().sort_values("rank")
    rolled = pdf.set_index(pd.to_datetime(pdf.us, unit="us"))
    error = (rolled.status_code >= 400).astype(float).rolling("5min", min_periods=1).mean()
    latency = rolled.response_time_ms.astype(float).rolling("5min", min_periods=1).mean()
    assert np.allclose(got.error_rate_5min, error) and np.allclose(got.avg_response_5min, latency)
    rt = pdf.response_time_ms.astype(float)
    assert np.allclose(got.response_time_zscore, (rt - rt.mean()) / rt.std())
    assert (got.request_count_per_ip.to_numpy() == pdf.groupby("ip_address").us.transform("count").to_numpy()).all()


def serving_reference(pdf):
    error = (pdf.status_code >= 400).astype(float).to_numpy()
    rt = pdf.response_time_ms.to_numpy(float)
    out = []
    for i in range(len(pdf)):
        e, r = error[max(0, i - 99): i + 1], rt[max(0, i - 99): i + 1]
        w = len(e) / 100
        out.append((w * e.mean() + (1 - w) * 0.05, w * r.mean() + (1 - w) * 150.0))
    return np.array(out)


@pytest.mark.parametrize("block", [100, 130])
def test_serving_features_equal_a_scan(spark, block):
    pdf = log_rows()
    df = spark.createDataFrame(pdf, SCHEMA)
    got = Fe.serving_features(df, rows_per_bucket=60, rows_per_block=block).toPandas().sort_values("rank")
    assert np.allclose(got[["error_rate_5min", "avg_response_5min"]], serving_reference(pdf))
    assert (got.request_count_per_ip.to_numpy() == (pdf.groupby("ip_address").cumcount() + 1).to_numpy()).all()
    assert got.is_warm.sum() == len(pdf) - 99 and got.window_size.max() == 100


def test_serving_batches_continue_the_sequence(spark, tmp_path):
    pdf = log_rows()
    df, state, got = spark.createDataFrame(pdf, SCHEMA), ScoringState(spark, str(tmp_path)), []
    for i, (a, b) in enumerate([(0, 40), (40, 41), (41, 200), (200, 260)]):
        part = df.filter(F.col("seq").between(a, b - 1))
        serving_batch(part, i, state, tie="seq").collect()
        got.append(serving_batch(part, i, state, tie="seq").toPandas())
    out = pd.concat(got).sort_values("seq")
    assert np.allclose(out[["error_rate_5min", "avg_response_5min"]], serving_reference(pdf))
    assert (out.request_count_per_ip.to_numpy() == (pdf.groupby("ip_address").cumcount() + 1).to_numpy()).all()


def test_fractional_latency_keeps_its_value(spark):
    pdf = log_rows(50)
    df = spark.createDataFrame(pdf, SCHEMA).withColumn("response_time_ms", F.col("response_time_ms") + 0.25)
    got = Fe.batch_features(df).toPandas().sort_values("rank")
    assert got.avg_response_5min.iloc[0] == pdf.response_time_ms.iloc[0] + 0.25


def test_legacy_features_switch_at_100(spark):
    pdf = log_rows()
    got = Fe.legacy_features(spark.createDataFrame(pdf, SCHEMA)).toPandas().sort_values("rank")
    assert (got.avg_response_5min[:99] == 200.0).all() and (got.error_rate_5min[:99] == 0.0).all()
    assert np.isclose(got.avg_response_5min.iloc[99], pdf.response_time_ms[:100].mean())
