"""The logs of queries whose rows are chosen by error, latency or anomaly have many of each kind."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def test_rows_sampled_for_alerts(spark):
    rows = QUERIES["P20_alert_sample"](spark, SF_DIR)
    slow = rows.filter(~F.col("log_level").isin("ERROR", "CRITICAL"))
    assert rows.count() >= 152
    assert slow.count() >= 48 and slow.filter("response_time_ms <= 2000").count() == 0


def test_more_anomalies_than_the_page_holds(spark):
    assert QUERIES["Q3_worst_anomalies"](spark, "/root/testdata/sf0.01").count() == 500


def test_replayed_and_anonymous_copies(spark):
    copies = {r["version"]: r["count"] for r in QUERIES["D1_keep_latest"](spark, SF_DIR).groupBy("version").count().collect()}
    assert copies["a"] + copies["b"] == 1000
    assert copies["b"] >= 161 and copies["c"] >= 171


def test_errors_on_the_spine(spark):
    assert QUERIES["J3_bucket_spine"](spark, SF_DIR).agg(F.sum("n")).first()[0] >= 104


def test_timeline_has_anomalies_that_are_no_errors(spark):
    errors, anomalies = QUERIES["A8_timeline"](spark, SF_DIR).agg(F.sum("error_count"), F.sum("anomaly_count")).first()
    assert errors >= 104 and anomalies >= errors + 48


def test_counted_anomalies(spark):
    row = QUERIES["A14_scoring_counters"](spark, SF_DIR).first()
    assert row["scored"] == 1000 and row["anomalies"] >= 152
