"""Small newest-first stores: the recent-log view and the alert log.

Each update writes the next version of at most N rows; a version is named after the batch that made it, so a
retried batch starts from the version before it and writes the same one again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.scalar import parse_iso
from emberlog.operators.dedupe import newest_distinct
from emberlog.schema import ALERTS_KEPT, RECENT_LOGS_KEPT
from emberlog.sources.documents import document
from emberlog.sources.versions import VersionedTable

ENTRY_SCHEMA = "score double, ident string, value string"


class NewestStore(VersionedTable):
    """The newest ``keep`` entries ``(score, ident, value)`` under ``path``; entries of one ``ident`` replace each other."""

    def __init__(self, spark: SparkSession, path: str, keep: int) -> None:
        super().__init__(spark, path, ENTRY_SCHEMA)
        self.keep = keep

    def update(self, entries: DataFrame, batch_id: int) -> None:
        """Merge the newest entries of a batch into the store."""
        newest = entries.orderBy(F.desc("score"), F.asc("ident")).limit(self.keep)
        merged = self.read(before=batch_id).select("score", "ident", "value", F.lit(0).alias("age")).unionByName(
            newest.select("score", "ident", "value", F.lit(1).alias("age"))
        )
        # At most two times ``keep`` rows.
        latest = merged.groupBy("ident").agg(F.max_by(F.struct("score", "value"), F.struct("age", "score")).alias("e"))
        out = latest.select("e.score", "ident", "e.value").orderBy(F.desc("score"), F.asc("ident")).limit(self.keep)
        self.write(out.coalesce(1), batch_id)

    def read(self, before: int | None = None) -> DataFrame:
        """The latest version, or the latest one before a batch; empty where there is none or it has been cleared."""
        found = [v for v in self.versions() if before is None or v < before]
        cleared = self.numbers("cleared")
        if not found or (cleared and found[-1] <= cleared[-1]):
            return self.spark.createDataFrame([], self.schema)
        return super().read(before)

    def clear(self) -> int:
        """Empty the store and return how many entries it had.

        A marker names the last batch that is cleared, so later batches start from nothing and a retried earlier one
        brings nothing back.
        """
        had = self.read().count()
        if versions := self.versions():
            self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(f"{self.path}/cleared={versions[-1]}")
        return had

    def count(self) -> int:
        return self.read().count()


def epoch_score(df: DataFrame):
    """Event time in seconds: the parsed instant, else the text, else now."""
    options = [F.unix_micros("timestamp") / 1e6] if "timestamp" in df.columns else []
    if "timestamp_text" in df.columns:
        options.append(F.unix_micros(parse_iso(F.col("timestamp_text"))) / 1e6)
    return F.coalesce(*options, F.unix_micros(F.current_timestamp()) / 1e6)


def log_entries(df: DataFrame, keep: int = RECENT_LOGS_KEPT) -> DataFrame:
    """The newest records of a table or batch as store entries."""
    newest = newest_distinct(df, keep)
    value = document(newest)
    ident = F.when(F.coalesce("request_id", F.lit("")) != "", F.col("request_id")).otherwise(F.sha2(value, 256))
    return newest.select(epoch_score(newest).alias("score"), ident.alias("ident"), value.alias("value"))


def alert_entries(alerts: DataFrame) -> DataFrame:
    """Alert records as store entries, scored by fire time."""
    fired = F.unix_micros(parse_iso(F.col("timestamp"))) / 1e6
    return alerts.select(fired.alias("score"), F.col("alert_id").alias("ident"), F.to_json(F.struct("*")).alias("value"))


def recent_log_store(spark: SparkSession, path: str) -> NewestStore:
    return NewestStore(spark, path, RECENT_LOGS_KEPT)


def alert_store(spark: SparkSession, path: str) -> NewestStore:
    return NewestStore(spark, path, ALERTS_KEPT)
