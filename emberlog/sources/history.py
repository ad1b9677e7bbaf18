"""The log history: Parquet partitioned by day and batch, appended idempotently and read deduplicated.

A batch owns its ``log_date=.../batch_id=...`` directories. Writing it again overwrites just those, so a retried
micro-batch costs an append and leaves no copies. Replayed records in later batches are resolved at read time;
compaction resolves them for good on closed days.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.operators.dedupe import keep_latest
from emberlog.schema import HISTORY_SCHEMA
from emberlog.session import unsorted_writes
from emberlog.sources.documents import history_columns
from emberlog.sources.timeindex import SCHEMA as INDEX_SCHEMA
from emberlog.sources.timeindex import TimeIndex, minute_counts, newest_matching, since

COMPACTED = -1
TARGET_FILE_BYTES = 256 * 1024 * 1024
_STORED = T.StructType(
    [*HISTORY_SCHEMA.fields, T.StructField("consumed_at", T.TimestampType()),
     T.StructField("log_date", T.DateType()), T.StructField("batch_id", T.LongType())]
)


class History:
    """A history table under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # --- files ---

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _bytes(self, path: str) -> int:
        fs, p = self._fs(path)
        return fs.getContentSummary(p).getLength()

    def days(self) -> list[date]:
        """The days that have a partition."""
        return [date.fromisoformat(c[9:]) for c in self._children(self.path) if c.startswith("log_date=")]

    # --- write ---

    def append(self, records: DataFrame, batch_id: int) -> None:
        """Write one batch; the same batch again replaces its own rows only."""
        consumed = F.col("consumed_at") if "consumed_at" in records.columns else F.current_timestamp()
        stored = records.select(
            *history_columns(records),
            consumed.alias("consumed_at"), F.to_date("timestamp").alias("log_date"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        # a task's rows lie in few days as a rule; sorted by day, they would all be held at once
        with unsorted_writes(records.sparkSession):
            stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "log_date", "batch_id"
            ).parquet(self.path)
        written = f"{self.path}/log_date=*/batch_id={batch_id}"
        fs, pattern = self._fs(written)
        if fs.globStatus(pattern):  # an empty batch has no folder
            self._count(self.spark.read.schema(_STORED).option("basePath", self.path).parquet(written))

    # --- index ---

    def _count(self, stored: DataFrame) -> None:
        """Write the rows per minute beside the batches they count, one file for each."""
        counts = minute_counts(stored, "batch_id").repartition("log_date", "batch_id")
        counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_date", "batch_id").parquet(f"{self.path}/_index")

    def index(self) -> TimeIndex:
        """Rows per minute of all stored rows, replays included.

        Batches without counts (a writer stopped between the two) are counted now, counts without a batch go.
        """
        path, missing = f"{self.path}/_index", []
        for day in (f"log_date={d.isoformat()}" for d in self.days()):
            there, counted = set(self._children(f"{self.path}/{day}")), set(self._children(f"{path}/{day}"))
            missing += [(day[9:], int(b[9:])) for b in sorted(there - counted) if b.startswith("batch_id=")]
            for stale in counted - there:
                self._delete(f"{path}/{day}/{stale}")
        for gone in set(self._children(path)) - {f"log_date={d.isoformat()}" for d in self.days()}:
            if gone.startswith("log_date="):
                self._delete(f"{path}/{gone}")
        if missing:
            wanted = F.broadcast(self.spark.createDataFrame(missing, "d string, b long"))  # uncounted batches only
            stored = self.stored()
            self._count(stored.join(wanted, (F.col("log_date") == F.to_date("d")) & (F.col("batch_id") == F.col("b")), "left_semi"))
        schema = "minute_us long, n long, log_date date, batch_id long"
        read = self.spark.read.schema(schema).parquet(path) if self._exists(path) else self.spark.createDataFrame([], INDEX_SCHEMA)
        return TimeIndex(read.select("log_date", "minute_us", "n"))

    def newest(self, n: int, where: Column | None = None) -> DataFrame:
        """Records, one row each, that certainly include the ``n`` newest matching ones; reads the days they lie in."""
        def read(us: int | None) -> DataFrame:
            start = None if us is None else datetime.fromtimestamp(us // 1_000_000, timezone.utc).date()
            return since(self.view(start=start), us)

        return newest_matching(read, self.index(), n, where)

    # --- read ---

    def stored(self) -> DataFrame:
        """All stored rows, replays included."""
        if not self.days():
            return self.spark.createDataFrame([], _STORED)
        return self.spark.read.schema(_STORED).parquet(self.path)

    def view(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """One row per record: the latest of each ``request_id`` within the days asked for, both included; reads only those."""
        rows = self.stored()
        rows = rows.filter(F.col("log_date") >= F.lit(start)) if start else rows
        rows = rows.filter(F.col("log_date") <= F.lit(end)) if end else rows
        return keep_latest(rows, order=("consumed_at", "batch_id", "timestamp"))

    # --- lifecycle ---

    def purge(self, as_of: datetime, max_age_days: int = 7) -> DataFrame:
        """Drop the days before ``as_of - max_age_days`` and report what went; a second call finds nothing."""
        if not 1 <= max_age_days <= 90:
            raise ValueError("max_age_days must be 1..90")
        cutoff = as_of.date() - timedelta(days=max_age_days)
        expired = [d for d in self.days() if d < cutoff]
        report_schema = "log_date date, removed_rows long"
        if not expired:
            return self.spark.createDataFrame([], report_schema)
        counts = self.stored().filter(F.col("log_date") < F.lit(cutoff)).groupBy("log_date").agg(
            F.count("*").alias("removed_rows")
        )
        report = [(r["log_date"], r["removed_rows"]) for r in counts.collect()]  # one row per expired day
        for d in expired:
            self._delete(f"{self.path}/log_date={d.isoformat()}")
            self._delete(f"{self.path}/_index/log_date={d.isoformat()}")
        return self.spark.createDataFrame(report, report_schema)

    def compact(self, day: date, target_bytes: int = TARGET_FILE_BYTES) -> int:
        """Rewrite a closed day as deduplicated files of about the target size; returns the number of files asked for.

        The new files are completed in a staging directory first, which readers do not see; its name lists no batches, so
        the batches it replaces are recorded beside it before it is written. Only those are deleted: rows that arrive
        meanwhile, or between an interrupted call and the one that finishes it, stay in their own batch folders.
        """
        folder = f"{self.path}/log_date={day.isoformat()}"
        staging = f"{self.path}/_compacting/log_date={day.isoformat()}"
        done = f"{staging}/_SUCCESS"
        files = 0
        if not self._exists(done):
            if not self._exists(folder):
                return 0
            sources = [c for c in self._children(folder) if c.startswith("batch_id=")]
            files = max(1, -(-self._bytes(folder) // target_bytes))
            batches = [int(c.removeprefix("batch_id=")) for c in sources]
            self.spark.createDataFrame([(c,) for c in sources], "source string").coalesce(1).write.mode("overwrite").parquet(f"{staging}-sources")
            rows = self.stored().filter((F.col("log_date") == F.lit(day)) & F.col("batch_id").isin(batches))
            latest = keep_latest(rows, order=("consumed_at", "batch_id", "timestamp")).drop("log_date", "batch_id")
            # Split by time and id, so that files skip on time predicates and no hot second makes a hot file.
            latest.repartitionByRange(files, "timestamp", "request_id").sortWithinPartitions("timestamp").write.mode(
                "overwrite"
            ).parquet(staging)
        self._publish(folder, staging)
        return files

    def _publish(self, folder: str, staging: str) -> None:
        for row in self.spark.read.schema("source string").parquet(f"{staging}-sources").collect():  # one row per batch
            if row["source"] != f"batch_id={COMPACTED}":
                self._delete(f"{folder}/{row['source']}")
        self._delete(f"{folder}/batch_id={COMPACTED}")
        fs, target = self._fs(f"{folder}/batch_id={COMPACTED}")
        _, source = self._fs(staging)
        fs.mkdirs(target.getParent())
        fs.rename(source, target)
        # counts of the files that are no more; the next reader of the index counts the new ones
        self._delete(f"{folder.replace(self.path, self.path + '/_index', 1)}/batch_id={COMPACTED}")
