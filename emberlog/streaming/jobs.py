"""Streaming queries: parse, score, store, alert, and continuous timelines."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from emberlog.functions.scalar import settled
from emberlog.operators.aggregates import rolling_summary
from emberlog.operators.parsing import parse_logs
from emberlog.schema import HISTORY_SCHEMA, RECENT_ROWS
from emberlog.session import scratch, stage
from emberlog.sources.documents import live_feed, strict_split
from emberlog.sources.artifacts import Bundle
from emberlog.sources.history import History
from emberlog.sources.latest import NewestStore, alert_entries, alert_store, log_entries, recent_log_store
from emberlog.sources.versions import VersionedTable
from emberlog.streaming.alerting import AlertState, alert_batch, notice_batch, notice_state
from emberlog.streaming.scoring import ScoringState, score_batch

ALL_SINKS = ("history", "recent", "feed", "alerts", "summary", "dead_letters")


def parsed_stream(messages: DataFrame) -> DataFrame:
    """Every message with its fields or its reject reason; received and rejected rows are observable metrics."""
    parsed = parse_logs(messages)
    stage_ = F.col("reject_stage")
    return parsed.observe(
        "pipeline",
        F.count(F.lit(1)).alias("received"),
        F.count_if(stage_.isNull()).alias("processed"),
        F.count_if(stage_ == "decode").alias("skipped_decode"),
        F.count_if(stage_ == "validate").alias("skipped_validate"),
        F.count_if(stage_ == "timestamp").alias("skipped_timestamp"),
    )


def timeline_stream(scored: DataFrame, width_s: int = 300, lateness: str = "1 minute") -> DataFrame:
    """Closed timeline buckets of a stream of scored records, each once, when the watermark has passed it."""
    width = f"{width_s} seconds"
    grouped = scored.withWatermark("timestamp", lateness).groupBy(F.window("timestamp", width))
    return grouped.agg(
        F.count("*").alias("total"),
        F.count_if("is_error").alias("error_count"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.round(F.avg("response_time_ms"), 1).alias("avg_response_ms"),
        settled(F.percentile("response_time_ms", 0.95), 1).alias("p95_response_ms"),
    ).select(F.unix_micros("window.start").alias("bucket_us"), "total", "error_count", "anomaly_count",
             "avg_response_ms", "p95_response_ms")


def observe_span(df: DataFrame) -> DataFrame:
    """Metric ``span``: newest and oldest event of each micro-batch; late rows proper are counted by the alert clock."""
    return df.observe(
        "span", F.max("timestamp").alias("newest"), F.min("timestamp").alias("oldest"), F.count(F.lit(1)).alias("rows")
    )


def drop_replays(df: DataFrame, lateness: str = "10 minutes", key: str = "request_id") -> DataFrame:
    """First of each key within the watermark; a later copy is dropped."""
    return df.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark([key])


@dataclass(frozen=True)
class Paths:
    """Where a pipeline keeps its tables and state."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


class LogPipeline:
    """One scored micro-batch to all switched-on sinks; every sink may see a batch again without changing."""

    def __init__(
        self, spark: SparkSession, root: str, model=None, scaler=None, stats: Mapping[str, float] | None = None,
        mode: str | None = "serving", sinks: Sequence[str] = ALL_SINKS,
        feed: Callable[[DataFrame, int], None] | None = None,
    ) -> None:
        unknown = set(sinks) - set(ALL_SINKS)
        if unknown:
            raise ValueError(f"unknown sinks: {sorted(unknown)}")
        paths = Paths(root)
        self.paths, self.sinks, self.feed = paths, set(sinks), feed
        self.model, self.scaler, self.stats, self.mode = model, scaler, stats, mode
        self.history = History(spark, paths.at("history"))
        self.recent = recent_log_store(spark, paths.at("recent"))
        self.alerts = alert_store(spark, paths.at("alerts"))
        self.window = NewestStore(spark, paths.at("window"), RECENT_ROWS)
        self.summaries = VersionedTable(spark, paths.at("summaries"), "summary string")
        self.scoring = ScoringState(spark, paths.at("state/scoring"))
        self.alerting = AlertState(spark, paths.at("state/alerting"))
        self.notices = notice_state(spark, paths.at("state/notices"))

    @classmethod
    def of(cls, spark: SparkSession, root: str, bundle: Bundle, **options) -> LogPipeline:
        """The pipeline that scores with a fitted bundle: its best model, scaler, feature form and latency statistics."""
        return cls(spark, root, bundle.best_model, bundle.scaler, bundle.stats, bundle.mode, **options)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Handle one micro-batch of parsed messages."""
        with scratch(batch.sparkSession):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        # The arrival number is stored with the batch, so all steps below see the same one.
        parsed = stage(batch.withColumn("arrival", F.monotonically_increasing_id()), "parsed")
        fits, misfits = strict_split(parsed.filter("reject_stage IS NULL"))
        if "dead_letters" in self.sinks:
            bad = parsed.filter("reject_stage IS NOT NULL").select("value", "reject_stage", "reject_reason")
            odd = misfits.select(
                "value", F.lit("schema").alias("reject_stage"),
                F.concat(F.lit("unknown:"), F.array_join("rejected_keys", ",")).alias("reject_reason"),
            )
            bad.unionByName(odd).write.mode("overwrite").parquet(self.paths.at(f"dead_letters/batch_id={batch_id}"))
        good = fits.drop("document", "reject_stage", "reject_reason", "value", "key")
        good = good.withColumn("us", F.unix_micros("timestamp"))
        scored = stage(
            score_batch(good, batch_id, self.scoring, self.model, self.scaler, self.stats, self.mode), "scored"
        )
        records = scored.drop("us", "arrival")
        if "history" in self.sinks:
            self.history.append(scored, batch_id)
        if "recent" in self.sinks:
            self.recent.update(log_entries(records), batch_id)
        if "alerts" in self.sinks:
            fired = alert_batch(scored, batch_id, self.alerting)
            self.alerts.update(alert_entries(fired), batch_id)
            notices = notice_batch(scored, batch_id, self.notices)
            notices.write.mode("overwrite").parquet(self.paths.at(f"notices/batch_id={batch_id}"))
        if "feed" in self.sinks and self.feed is not None:
            self.feed(live_feed(records), batch_id)
        if "summary" in self.sinks:
            self.window.update(log_entries(records, RECENT_ROWS), batch_id)
            rows = self.window.read().select(F.from_json("value", HISTORY_SCHEMA).alias("r")).select("r.*")
            self.summaries.write(rolling_summary(rows).select(F.to_json(F.struct("*")).alias("summary")), batch_id)

    def writer(self, messages: DataFrame) -> DataStreamWriter:
        """The streaming writer over ``key, value`` messages; choose a trigger and start it."""
        return (
            parsed_stream(messages).writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self.paths.at("checkpoint")).queryName("log-pipeline")
        )

    def drain(self, messages: DataFrame) -> StreamingQuery:
        """Process what is there, then stop."""
        query = self.writer(messages).trigger(availableNow=True).start()
        query.awaitTermination()
        return query


def append_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a streaming DataFrame over the available input into a Parquet table."""
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
