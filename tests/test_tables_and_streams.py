"""History, newest-N stores, state tables and the streaming pipeline."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.operators.models.forest import fit_decision, fit_forest
from emberlog.operators.models.scaling import fit_scaler
from emberlog.operators.search import in_last, recent_alerts, recent_logs, search_logs
from emberlog.operators.features import serving_features
from emberlog.schema import MODEL_FEATURES
from emberlog.sources.documents import live_feed
from emberlog.sources.history import COMPACTED, History
from emberlog.sources.latest import NewestStore, alert_store
from emberlog.sources.readers import message_files, training_csv
from emberlog.sources.versions import RunningSums
from emberlog.streaming.jobs import LogPipeline

START = datetime(2024, 6, 15, 9, 0)


def records(spark, ids, day=0, status=200, consumed=0):
    rows = [(START + timedelta(days=day, seconds=i), f"r{i}" if i >= 0 else "", "INFO", "s", status,
             START + timedelta(days=40, seconds=consumed)) for i in ids]
    return spark.createDataFrame(
        rows, "timestamp timestamp, request_id string, log_level string, service_name string, status_code int, consumed_at timestamp"
    )


def test_a_retried_batch_leaves_no_copies(spark, tmp_path):
    history = History(spark, str(tmp_path))
    for _ in range(2):
        history.append(records(spark, [1, 2, -1, -2]), 0)
    history.append(records(spark, [2, 3], status=500, consumed=5), 1)
    assert history.stored().count() == 6
    got = {r.request_id: r.status_code for r in history.view().filter("request_id <> ''").collect()}
    assert got == {"r1": 200, "r2": 500, "r3": 500} and history.view().count() == 5


def test_whole_rows_are_not_sorted_to_find_replays(spark, tmp_path):
    """Neither the joins with repeated ids nor a write by day hold the rows of a task in a sort."""
    history, name = History(spark, str(tmp_path / "h")), "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    many = records(spark, range(6))
    for day in range(1, 12):  # more days than open files
        many = many.unionByName(records(spark, range(6 * day, 6 * day + 6), day=day))
    history.append(many.coalesce(1), 0)
    history.append(records(spark, (3, 4), status=500, consumed=1), 1)
    assert spark.conf.get(name) == before
    view = history.view()
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("ShuffledHashJoin") == 2
    got = {r["request_id"]: r["status_code"] for r in view.collect()}
    assert len(got) == 72 and sum(v == 500 for v in got.values()) == 2


def test_purge_is_idempotent(spark, tmp_path):
    history = History(spark, str(tmp_path))
    for day in range(4):
        history.append(records(spark, range(day + 1), day), day)
    now = START + timedelta(days=4)
    report = {r.log_date: r.removed_rows for r in history.purge(now, 2).collect()}
    assert report == {date(2024, 6, 15): 1, date(2024, 6, 16): 2}
    assert history.purge(now, 2).count() == 0 and history.days() == [date(2024, 6, 17), date(2024, 6, 18)]
    with pytest.raises(ValueError):
        history.purge(now, 0)


def test_compaction_and_recovery(spark, tmp_path):
    history = History(spark, str(tmp_path))
    history.append(records(spark, range(5)), 0)
    history.append(records(spark, range(3), status=500, consumed=5), 1)
    day, want = date(2024, 6, 15), sorted(map(tuple, history.view().select("request_id", "status_code").collect()))
    rename = History._fs

    def broken(self, path):
        if path.endswith(f"batch_id={COMPACTED}"):
            raise OSError("lost")
        return rename(self, path)

    History._fs = broken
    try:
        with pytest.raises(OSError):
            history.compact(day)
    finally:
        History._fs = rename
    history.compact(day)
    assert sorted(map(tuple, history.stored().select("request_id", "status_code").collect())) == want
    assert {r.batch_id for r in history.stored().select("batch_id").collect()} == {COMPACTED}
    history.compact(day)
    history.append(records(spark, [9]), 2)
    history.compact(day)
    assert history.stored().count() == len(want) + 1


def test_time_predicates_prune_days_and_reach_the_scan(spark, tmp_path):
    history = History(spark, str(tmp_path))
    for day in range(3):
        history.append(records(spark, range(3), day), day)
    plan = in_last(history.stored(), START + timedelta(days=2, hours=1), hours=2).select("service_name")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in text and "GreaterThanOrEqual(timestamp" in text
    read = text[text.index("ReadSchema"):]
    assert "status_code" not in read.splitlines()[0] and plan.count() == 3
    found = search_logs(history.stored(), level="INFO", status_code=200).matches
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(log_level,INFO)" in text and "EqualTo(status_code,200)" in text


def entries(spark, scores):
    return spark.createDataFrame([(float(s), f"e{s}", f'{{"log_level":"INFO","n":{s}}}') for s in scores],
                                 "score double, ident string, value string")


def test_newest_store_trims_and_survives_retries(spark, tmp_path):
    store = NewestStore(spark, str(tmp_path), 3)
    store.update(entries(spark, [1, 2]), 0)
    for _ in range(2):
        store.update(entries(spark, [2, 3, 4]), 1)
    assert [r.ident for r in store.read().orderBy(F.desc("score")).collect()] == ["e4", "e3", "e2"]
    for batch in range(2, 8):
        store.update(entries(spark, [10 + batch]), batch)
    assert len(store.versions()) == 3
    assert store.clear() == 3 and store.count() == 0 and store.clear() == 0


def test_corrupt_entries_are_skipped_on_read(spark, tmp_path):
    store = alert_store(spark, str(tmp_path))
    values = [(1.0, "a", '{"alert_id":"a"}'), (2.0, "b", "{oops"), (3.0, "c", '{"alert_id":"c"}')]
    store.update(spark.createDataFrame(values, "score double, ident string, value string"), 0)
    assert sorted(r.alert_id for r in recent_alerts(store.read()).collect()) == ["a", "c"]
    assert recent_logs(store.read()).count() == 2


def test_running_sums_compact_and_retry(spark, tmp_path):
    sums = RunningSums(spark, str(tmp_path), "ip_address")
    one = spark.createDataFrame([("a", 2), ("b", 1)], "ip_address string, n long")
    for batch in range(60):
        sums.add(one, batch)
    assert {r.ip_address: r.n for r in sums.read(60).collect()} == {"a": 120, "b": 60}
    assert {r.ip_address: r.n for r in sums.read(59).collect()} == {"a": 118, "b": 59}
    assert len(sums.numbers("increment")) < 20


def test_live_feed_defaults(spark):
    df = spark.createDataFrame([("a", True, 0.5, None), ("b", None, None, "alert")],
                               "request_id string, is_anomaly boolean, anomaly_score double, type string")
    got = [json.loads(r.payload) for r in live_feed(df).orderBy("request_id").collect()]
    assert got[0] == {"request_id": "a", "is_anomaly": True, "anomaly_score": 0.5, "type": "anomaly"}
    assert got[1] == {"request_id": "b", "is_anomaly": False, "anomaly_score": 0.0, "type": "alert"}


def test_training_csv_needs_its_columns(spark, tmp_path):
    spark.createDataFrame([("2024-06-15T09:00:00Z", "INFO")], "timestamp string, log_level string").write.option(
        "header", True).csv(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="response_time_ms"):
        training_csv(spark, str(tmp_path / "bad"))


def messages(spark, ids):
    rows = []
    for i in ids:
        body = {
            "timestamp": (START + timedelta(seconds=i)).isoformat() + "+00:00", "log_level": "ERROR" if i % 3 == 0 else "INFO",
            "service_name": "s", "endpoint": "/x", "response_time_ms": 9000 if i % 3 == 0 else 50 + i % 7,
            "status_code": 503 if i % 3 == 0 else 200, "user_id": "u", "ip_address": f"10.0.0.{i % 4}", "message": "m",
            "request_id": f"r{i}",
        }
        rows.append(("s", bytearray(json.dumps(body).encode())))
    rows.append(("s", bytearray(b"{broken")))
    return spark.createDataFrame(rows, "key string, value binary")


def fitted(spark, topic):
    """A model on the serving features of the same messages."""
    from emberlog.operators.parsing import parse_logs, valid_logs

    rows = valid_logs(parse_logs(topic)).withColumn("us", F.unix_micros("timestamp"))
    rows = rows.withColumn("seq", F.col("us"))
    features = serving_features(rows.select("us", "seq", "log_level", "status_code", "response_time_ms", "ip_address"))
    scaler = fit_scaler(features)
    scaled = scaler.transform(features).select("us", "seq", *MODEL_FEATURES).cache()
    return scaler, fit_decision(fit_forest(scaled, trees=20), scaled, 0.3)


def test_pipeline_scores_alerts_and_restarts(spark, tmp_path):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "root")
    first, second = messages(spark, range(0, 150)), messages(spark, range(150, 300))
    scaler, model = fitted(spark, first.unionByName(second))
    fed = []
    pipeline = LogPipeline(spark, root, model, scaler, feed=lambda df, i: fed.append(df.count()))
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(topic)
        pipeline.drain(message_files(spark, topic))
    stored = pipeline.history.view()
    assert stored.count() == 300 and sum(fed) == 300
    assert spark.read.parquet(f"{root}/dead_letters").count() == 2
    flagged = stored.filter("is_anomaly").count()
    assert 0 < flagged < 300
    assert pipeline.alerts.count() > 0 and pipeline.recent.count() == 300
    assert json.loads(pipeline.summaries.read().first().summary)["window_size"] == 300

    before = (stored.orderBy("request_id").drop("consumed_at").collect(), pipeline.alerts.read().collect())
    from emberlog.operators.parsing import parse_logs

    pipeline.process(parse_logs(second), 1)
    after = (pipeline.history.view().orderBy("request_id").drop("consumed_at").collect(), pipeline.alerts.read().collect())
    assert before[0] == after[0] and sorted(before[1]) == sorted(after[1])


def test_pipeline_without_a_model_flags_nothing(spark, tmp_path):
    topic = str(tmp_path / "topic")
    messages(spark, range(20)).write.parquet(topic)
    pipeline = LogPipeline(spark, str(tmp_path / "root"), sinks=("history",))
    pipeline.drain(message_files(spark, topic))
    assert pipeline.history.stored().filter("is_anomaly OR anomaly_score <> 0").count() == 0
    assert pipeline.recent.count() == 0
    with pytest.raises(ValueError):
        LogPipeline(spark, str(tmp_path / "x"), sinks=("mail",))


def test_csv_to_a_fitted_bundle_and_its_statistics(spark, tmp_path):
    """Training reads the CSV as it comes; the bundle carries the latency statistics that serving uses."""
    from emberlog.plans.training import train
    from emberlog.sources.artifacts import load_bundle, save_bundle

    lines = [((START + timedelta(seconds=i // 2)).isoformat() + "+00:00", "ERROR" if i % 9 == 0 else "INFO", "s", 10 + i % 50, 500 if i % 9 == 0 else 200, f"10.0.0.{i % 4}") for i in range(240)]
    columns = "timestamp string, log_level string, service_name string, response_time_ms int, status_code int, ip_address string"
    spark.createDataFrame(lines, columns).repartition(3).write.option("header", True).csv(str(tmp_path / "csv"))
    raw = training_csv(spark, str(tmp_path / "csv"))
    bundle, comparison, _ = train(raw, [], trees=10)
    save_bundle(spark, bundle, str(tmp_path / "models"), comparison)
    loaded = load_bundle(spark, str(tmp_path / "models"))
    want = raw.agg(F.round(F.avg("response_time_ms"), 4), F.round(F.stddev_samp("response_time_ms"), 4)).first()
    assert loaded.stats == {"mean": want[0], "std": want[1]} and loaded.contamination == bundle.contamination
    pipeline = LogPipeline.of(spark, str(tmp_path / "live"), loaded)
    assert pipeline.stats == loaded.stats and pipeline.mode == "batch"


def test_training_csv_refuses_bad_timestamps(spark, tmp_path):
    rows = [("2024-06-15T09:00:00Z", "INFO", 5, 200, "a"), ("yesterday", "INFO", 5, 200, "a")]
    spark.createDataFrame(rows, "timestamp string, log_level string, response_time_ms int, status_code int, ip_address string").write.option("header", True).csv(str(tmp_path / "c"))
    with pytest.raises(Exception, match="not a timestamp: yesterday"):
        training_csv(spark, str(tmp_path / "c")).select("us").collect()
