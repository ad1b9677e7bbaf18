"""Registered queries on stored tables and streams. Streams read the whole log table in consecutive time slices."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators import aggregates as G
from emberlog.operators import alerts as A
from emberlog.operators import features as Fe
from emberlog.operators import search as S
from emberlog.plans.catalog import ENTRIES, query
from emberlog.plans.queries import listing, logs
from emberlog.plans.queries_parsing import CYCLE, PARSE_CTE, raw_messages
from emberlog.schema import HISTORY_SCHEMA, RECENT_ROWS
from emberlog.session import fresh_path
from emberlog.sources.documents import publish
from emberlog.sources.history import History
from emberlog.sources.latest import NewestStore, alert_entries, alert_store, log_entries, recent_log_store
from emberlog.sources.readers import message_files, training_csv
from emberlog.sources.versions import VersionedTable
from emberlog.streaming.alerting import AlertState, alert_batch, notice_batch, notice_state
from emberlog.streaming.jobs import LogPipeline, append_stream, drop_replays, parsed_stream, timeline_stream
from emberlog.streaming.scoring import ScoringState, serving_batch

SLICES = 3


def sliced_run(df: DataFrame, path: str, run: Callable[[], None]) -> None:
    """Append consecutive time slices of ``df`` to ``path`` and call ``run`` after each: a stream with restarts."""
    low, high = df.agg(F.min("us"), F.max("us")).first()
    step = (high - low) // SLICES + 1
    for i in range(SLICES):
        part = df.filter((F.col("us") >= low + i * step) & (F.col("us") < low + (i + 1) * step))
        part.write.mode("append").parquet(path)
        run()


def batch_stream(spark: SparkSession, df: DataFrame, handle: Callable[[DataFrame, int], None]) -> None:
    """Feed ``df`` through a file stream whose micro-batches ``handle`` processes."""
    source, checkpoint = fresh_path(spark, "topic"), fresh_path(spark, "checkpoint")

    def run() -> None:
        stream = spark.readStream.schema(df.schema).parquet(source)
        writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    sliced_run(df, source, run)


STREAM_COLUMNS = (
    "us", "seq", "timestamp", "log_level", "service_name", "endpoint", "status_code", "response_time_ms", "ip_address",
    "message", "request_id", "is_anomaly", "anomaly_score",
)


@query(
    "W01_stream_parse", "seq:i stage:s reason:s us:i",
    PARSE_CTE + " => SELECT seq, stage, reason, CASE WHEN stage = 'ok' THEN us END AS us FROM parsed",
)
def _(spark, sf_dir):
    source, out, checkpoint = (fresh_path(spark, n) for n in ("topic", "parsed", "checkpoint"))
    raw_messages(spark, sf_dir).write.parquet(source)
    stream = spark.readStream.schema("seq long, key string, value binary").parquet(source)
    fields = parsed_stream(stream).select("seq", "reject_stage", "reject_reason", "timestamp")
    append_stream(fields, out, checkpoint)
    return spark.read.parquet(out).select(
        "seq", F.coalesce("reject_stage", F.lit("ok")).alias("stage"),
        F.coalesce("reject_reason", F.lit("ok")).alias("reason"),
        F.when(F.col("reject_stage").isNull(), F.unix_micros("timestamp")).alias("us"),
    )


@query("S01_published_topic", "key:s n:i", "SELECT service_name AS key, count(*) AS n FROM logs GROUP BY 1")
def _(spark, sf_dir):
    path, out, checkpoint = (fresh_path(spark, n) for n in ("topic", "read", "checkpoint"))
    publish(logs(spark, sf_dir), format="parquet", path=path)
    topic = message_files(spark, path).select("key", F.length("value").alias("size"))
    append_stream(topic, out, checkpoint)
    return spark.read.parquet(out).groupBy("key").agg(F.count("*").alias("n"))


@query(
    "S03_training_csv", "n:i first_us:i last_us:i sum_ms:i",
    "SELECT count(*) AS n, min(us) AS first_us, max(us) AS last_us, sum(response_time_ms) AS sum_ms FROM logs",
)
def _(spark, sf_dir):
    path = fresh_path(spark, "csv")
    columns = ("log_level", "service_name", "endpoint", "response_time_ms", "status_code", "user_id", "ip_address",
               "request_id", "region", "environment")
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp")
    logs(spark, sf_dir).select(stamp, *columns).write.option("header", True).csv(path)
    base = Fe.base_features(training_csv(spark, path))
    return base.agg(
        F.count("*").alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.sum("rt").alias("sum_ms")
    )


@query(
    "S05_history_replay", "request_id:s us:i status_code:i",
    "SELECT request_id, us, CASE WHEN is_error THEN 599 ELSE status_code END AS status_code FROM logs",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir)
    history = History(spark, fresh_path(spark, "history"))
    at = F.lit("2024-06-16 00:00:00").cast("timestamp")
    history.append(df.withColumn("consumed_at", at), 0)
    history.append(df.withColumn("consumed_at", at), 0)
    changed = df.filter("is_error").withColumns(
        {"status_code": F.lit(599), "consumed_at": at + F.expr("INTERVAL 1 HOUR")}
    )
    history.append(changed, 1)
    return history.view().withColumn("us", F.unix_micros("timestamp"))


@query(
    "S04_history_day", "n:i errors:i",
    "SELECT count(*) AS n, count(*) FILTER (is_error) AS errors FROM logs WHERE timestamp::DATE = DATE '2024-06-15'",
)
def _(spark, sf_dir):
    history = History(spark, fresh_path(spark, "history"))
    history.append(logs(spark, sf_dir), 0)
    day = history.stored().filter(F.col("log_date") == F.lit(date(2024, 6, 15)))
    return day.agg(F.count("*").alias("n"), F.count_if("is_error").alias("errors"))


SHIFTED = "timestamp + to_days(CAST(seq % 5 AS INTEGER))"


def _five_days(spark, sf_dir) -> History:
    """The log table spread over five days."""
    df = logs(spark, sf_dir)
    moved = F.timestamp_micros(F.col("us") + (F.col("seq") % 5) * 86_400_000_000)
    history = History(spark, fresh_path(spark, "history"))
    history.append(df.withColumn("timestamp", moved), 0)
    return history


@query(
    "L1_retention_purge", "log_date:s n:i",
    f"SELECT strftime({SHIFTED}, '%Y-%m-%d') AS log_date, count(*) AS n FROM logs "
    f"WHERE ({SHIFTED})::DATE >= DATE '2024-06-17' GROUP BY 1",
)
def _(spark, sf_dir):
    history = _five_days(spark, sf_dir)
    history.purge(datetime(2024, 6, 20, 12), max_age_days=3)
    return history.stored().groupBy("log_date").agg(F.count("*").alias("n"))


@query(
    "L2_compaction", "log_date:s batches:i n:i",
    f"SELECT strftime({SHIFTED}, '%Y-%m-%d') AS log_date, 1 AS batches, count(*) AS n FROM logs GROUP BY 1",
)
def _(spark, sf_dir):
    history = _five_days(spark, sf_dir)
    history.append(history.stored().drop("log_date", "batch_id"), 1)
    for day in history.days():
        history.compact(day)
    return history.stored().groupBy("log_date").agg(
        F.count_distinct("batch_id").alias("batches"), F.count("*").alias("n")
    )


@query(
    "L2_late_rows", "request_id:s us:i", "SELECT request_id, us FROM logs",
)
def _(spark, sf_dir):
    """A compaction that stops before its files are published, rows that arrive late, and the call that finishes it."""
    history = History(spark, fresh_path(spark, "history"))
    df = logs(spark, sf_dir)
    history.append(df.filter("seq % 50 <> 7"), 0)
    history.append(df.filter("seq % 3 = 0 and seq % 50 <> 7"), 1)
    publish = history._publish
    history._publish = lambda *_: None
    for day in history.days():
        history.compact(day)
    history._publish = publish
    history.append(df.filter("seq % 50 = 7"), 2)
    for day in history.days():
        history.compact(day)
    return history.view().withColumn("us", F.unix_micros("timestamp"))


# --- latest-N stores -----------------------------------------------------------------------------------------

@query("S08_latest_logs", "request_id:s us:i", "SELECT request_id, us FROM logs ORDER BY us DESC, request_id LIMIT 500")
def _(spark, sf_dir):
    store = recent_log_store(spark, fresh_path(spark, "recent"))
    df = logs(spark, sf_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.update(log_entries(batch), batch_id)

    batch_stream(spark, df.drop("log_date", "seq"), handle)
    us = F.round(F.col("score") * 1_000_000)
    return store.read().select(F.col("ident").alias("request_id"), us.alias("us"))


@query(
    "Q4_recent_logs", "request_id:s log_level:s service_name:s status_code:i is_error:b",
    "SELECT * FROM logs ORDER BY us DESC, request_id LIMIT 50",
)
def _(spark, sf_dir):
    store = recent_log_store(spark, fresh_path(spark, "recent"))
    store.update(log_entries(logs(spark, sf_dir)), 0)
    return S.recent_logs(store.read())


_ALERT_SQL = ENTRIES["W3_alerts"].sql.rpartition("=>")


def _alert_log(spark, sf_dir) -> NewestStore:
    store = alert_store(spark, fresh_path(spark, "alerts"))
    store.update(alert_entries(A.alerts(logs(spark, sf_dir))), 0)
    return store


@query(
    "S09_alert_log", "ident:s fired_us:i",
    f"{_ALERT_SQL[0]}, a AS ({_ALERT_SQL[2].replace('SELECT concat', 'SELECT c.us AS us_, concat', 1)}) => "
    "SELECT alert_id AS ident, us_ AS fired_us FROM a ORDER BY us_ DESC LIMIT 100",
)
def _(spark, sf_dir):
    return _alert_log(spark, sf_dir).read().withColumn("fired_us", F.round(F.col("score") * 1_000_000))


@query(
    "Q5_recent_alerts", "alert_id:s severity:s anomaly_count:i rate_per_min:d",
    f"{_ALERT_SQL[0]}, a AS ({_ALERT_SQL[2].replace('SELECT concat', 'SELECT c.us AS us_, concat', 1)}) => "
    "SELECT * FROM a ORDER BY us_ DESC LIMIT 20",
)
def _(spark, sf_dir):
    return S.recent_alerts(_alert_log(spark, sf_dir).read())


@query(
    "S10_clear_alerts", "deleted:i remaining:i",
    f"{_ALERT_SQL[0]}, a AS ({_ALERT_SQL[2]}) => SELECT least(count(*), 100) AS deleted, 0 AS remaining FROM a",
)
def _(spark, sf_dir):
    store = _alert_log(spark, sf_dir)
    deleted = store.clear()
    return store.read().agg(F.count("*").alias("remaining")).withColumn("deleted", F.lit(deleted))


@query(
    "S10_clear_then_batch", "request_id:s us:i", "SELECT request_id, us FROM logs WHERE seq % 4 = 1 ORDER BY us DESC, request_id LIMIT 500",
)
def _(spark, sf_dir):
    """After a clear, a retried earlier batch brings nothing back and the next batch starts from nothing."""
    store, df = recent_log_store(spark, fresh_path(spark, "recent")), logs(spark, sf_dir)
    store.update(log_entries(df.filter("seq % 4 = 0")), 0)
    store.clear()
    store.update(log_entries(df.filter("seq % 4 = 0")), 0)
    store.update(log_entries(df.filter("seq % 4 = 1")), 1)
    return store.read().select(F.col("ident").alias("request_id"), F.round(F.col("score") * 1_000_000).alias("us"))


# --- streams -------------------------------------------------------------------------------------------------

@query("W2_streaming_features", ENTRIES["F07_serving_features"].columns, ENTRIES["F07_serving_features"].sql)
def _(spark, sf_dir):
    state = ScoringState(spark, fresh_path(spark, "state"))
    out = fresh_path(spark, "features")
    kept = ("seq", "error_rate_5min", "avg_response_5min", "request_count_per_ip", "response_time_zscore", "window_size", "is_warm")

    def handle(batch: DataFrame, batch_id: int) -> None:
        features = serving_batch(batch, batch_id, state, tie="seq")
        features.select(*kept).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    batch_stream(spark, logs(spark, sf_dir).select(*STREAM_COLUMNS), handle)
    return spark.read.parquet(out)


@query("W3_streaming_alerts", ENTRIES["W3_alerts"].columns, ENTRIES["W3_alerts"].sql)
def _(spark, sf_dir):
    state = AlertState(spark, fresh_path(spark, "state"))
    out = fresh_path(spark, "alerts")

    def handle(batch: DataFrame, batch_id: int) -> None:
        alert_batch(batch, batch_id, state, tie="seq").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    batch_stream(spark, logs(spark, sf_dir).select(*STREAM_COLUMNS), handle)
    return spark.read.parquet(out).select(
        "*", F.col("sample_log.service_name").alias("service_name"), F.col("sample_log.anomaly_score").alias("sample_score"),
        F.col("sample_log.message").alias("sample_message"),
    )


@query("W5_streaming_notices", ENTRIES["W5_notices"].columns, ENTRIES["W5_notices"].sql)
def _(spark, sf_dir):
    state = notice_state(spark, fresh_path(spark, "state"))
    out = fresh_path(spark, "notices")

    def handle(batch: DataFrame, batch_id: int) -> None:
        notice_batch(batch, batch_id, state, tie="seq").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    batch_stream(spark, logs(spark, sf_dir).select(*STREAM_COLUMNS), handle)
    return spark.read.parquet(out)


@query(
    "W6_streaming_timeline",
    "bucket_us:i total:i error_count:i anomaly_count:i avg_response_ms:d p95_response_ms:d",
    "SELECT us - us % 60000000 AS bucket_us, count(*) AS total, count(*) FILTER (is_error) AS error_count, "
    "count(*) FILTER (is_anomaly) AS anomaly_count, round(avg(response_time_ms), 1) AS avg_response_ms, "
    "round(round(quantile_cont(response_time_ms, 0.95), 6), 1) AS p95_response_ms FROM logs GROUP BY 1 "
    "HAVING bucket_us + 60000000 <= (SELECT now_us // 1000 * 1000 - 60000000 FROM now_)",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir).select("us", "timestamp", "is_error", "is_anomaly", "response_time_ms")
    source, out, checkpoint = (fresh_path(spark, n) for n in ("topic", "timeline", "checkpoint"))

    def run() -> None:
        append_stream(timeline_stream(spark.readStream.schema(df.schema).parquet(source), width_s=60), out, checkpoint)

    sliced_run(df, source, run)
    return spark.read.parquet(out)


@query("D1_stream_first_wins", "request_id:s n:i", "SELECT request_id, 1 AS n FROM logs")
def _(spark, sf_dir):
    df = logs(spark, sf_dir).select("request_id", "timestamp")
    source, out, checkpoint = (fresh_path(spark, n) for n in ("topic", "first", "checkpoint"))
    df.write.parquet(source)
    df.write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    append_stream(drop_replays(stream, "1 day"), out, checkpoint)
    return spark.read.parquet(out).groupBy("request_id").agg(F.count("*").alias("n"))


@query("W9_streaming_summary", ENTRIES["A5_rolling_summary"].columns, ENTRIES["A5_rolling_summary"].sql)
def _(spark, sf_dir):
    window = NewestStore(spark, fresh_path(spark, "window"), RECENT_ROWS)
    schema = G.rolling_summary(logs(spark, sf_dir)).schema
    summaries = VersionedTable(spark, fresh_path(spark, "summaries"), "summary string")

    def handle(batch: DataFrame, batch_id: int) -> None:
        window.update(log_entries(batch, RECENT_ROWS), batch_id)
        rows = window.read().select(F.from_json("value", HISTORY_SCHEMA).alias("r")).select("r.*")
        summaries.write(G.rolling_summary(rows).select(F.to_json(F.struct("*")).alias("summary")), batch_id)

    batch_stream(spark, logs(spark, sf_dir).drop("log_date", "seq"), handle)
    last = summaries.read().select(F.from_json("summary", schema).alias("s")).select("s.*")
    return last.withColumn("top_services", listing("top_services", "service", "count"))


@query(
    "S15_fan_out", "sink:s n:i",
    PARSE_CTE + f", good AS (SELECT count(*) AS n FROM parsed WHERE stage = 'ok' AND seq % {CYCLE} <> 41) => "
    "SELECT 'history' AS sink, n FROM good UNION ALL SELECT 'recent', least(n, 500) FROM good UNION ALL SELECT 'alerts', 0 "
    "UNION ALL SELECT 'summary', 1 UNION ALL SELECT 'feed', n FROM good UNION ALL "
    "SELECT 'dead_letters', (SELECT count(*) FROM logs) - n FROM good",
)
def _(spark, sf_dir):
    root, topic = fresh_path(spark, "pipeline"), fresh_path(spark, "topic")

    def feed(batch: DataFrame, batch_id: int) -> None:
        batch.select("payload").write.mode("overwrite").parquet(f"{root}/feed/batch={batch_id}")

    pipeline = LogPipeline(spark, root, feed=feed)
    messages = raw_messages(spark, sf_dir).select("key", "value")
    messages.write.parquet(topic)
    pipeline.drain(message_files(spark, topic))
    counts = {
        "history": pipeline.history.view(), "recent": pipeline.recent.read(), "alerts": pipeline.alerts.read(),
        "summary": pipeline.summaries.read(), "feed": spark.read.parquet(f"{root}/feed"),
        "dead_letters": spark.read.parquet(f"{root}/dead_letters"),
    }
    out = None
    for sink, df in counts.items():
        row = df.agg(F.count("*").alias("n")).withColumn("sink", F.lit(sink))
        out = row if out is None else out.unionByName(row)
    return out
