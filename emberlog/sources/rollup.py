"""Five-minute rollups of the log stream with mergeable sketches: long timelines and latency profiles without the raw rows.

Each batch adds its own partial rows, one per (bucket, service), under its batch id; a retried batch replaces just those. Late rows
are partial rows of an old bucket in a new batch, so they are merged in whenever they come. Readers merge partial rows; ``compact``
merges those of a day for good. A rollup counts the rows it is given: replays are to be dropped before.

Counts, sums, extremes, averages and deviations are exact. Percentiles come from KLL sketches, whose rank is off by at most
``RANK_ERROR`` with 99 % confidence, however many sketches are merged; distinct addresses from HLL sketches, whose standard error is
``DISTINCT_ERROR``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.scalar import epoch_bucket_us, settled
from emberlog.operators.joins import bucket_spine, fill_spine
from emberlog.schema import MICROS
from emberlog.sources.versions import Folder

SKETCH_K, LG_K = 800, 12
#: 2.296 / k ** 0.9723 and 1.04 / sqrt(2 ** lgK), the sketches' own formulas.
RANK_ERROR, DISTINCT_ERROR = 0.0035, 0.017
SCHEMA = (
    "bucket_us long, service_name string, total long, error_count long, anomaly_count long, timed long, sum_ms decimal(38,6), "
    "sum_sq decimal(38,6), min_ms double, max_ms double, latency binary, addresses binary, log_date date"
)
_COLUMNS = tuple(c.split()[0] for c in SCHEMA.split(", "))
_SUMS = ("total", "error_count", "anomaly_count", "timed", "sum_ms", "sum_sq")


def partial_rows(df: DataFrame, width_s: int = 300) -> DataFrame:
    """One row per bucket and service of scored records; rows without an instant are left out, null latencies are not timed."""
    ms = F.col("response_time_ms").cast("double")
    exact = F.col("response_time_ms").cast("decimal(18,3)")
    us = F.unix_micros("timestamp")
    grouped = df.filter(F.col("timestamp").isNotNull()).groupBy(epoch_bucket_us(us, width_s).alias("bucket_us"), "service_name").agg(
        F.count("*").alias("total"), F.count_if("is_error").alias("error_count"), F.count_if("is_anomaly").alias("anomaly_count"),
        F.count(ms).alias("timed"), F.sum(exact).cast("decimal(38,6)").alias("sum_ms"), F.sum(exact * exact).cast("decimal(38,6)").alias("sum_sq"),
        F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"),
        F.kll_sketch_agg_double(ms, SKETCH_K).alias("latency"), F.hll_sketch_agg("ip_address", LG_K).alias("addresses"),
    )
    return grouped.withColumn("log_date", F.to_date(F.timestamp_micros("bucket_us")))


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Partial rows merged per ``keys``; copies of one key combine before the shuffle."""
    return rows.groupBy(*keys).agg(
        *[F.sum(c).cast("decimal(38,6)" if c.startswith("sum") else "long").alias(c) for c in _SUMS],
        F.min("min_ms").alias("min_ms"), F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_double("latency", SKETCH_K).alias("latency"), F.hll_union_agg("addresses").alias("addresses"),
    )


def _quantile(share: float) -> Column:
    return F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_double("latency", F.lit(share)))


def _mean() -> Column:
    return F.try_divide(F.col("sum_ms").cast("double"), F.col("timed"))


class Rollup(Folder):
    """Rollup rows under ``path``: ``open`` holds the batches, ``closed`` the merged days with the last batch they hold."""

    def __init__(self, spark: SparkSession, path: str, width_s: int = 300) -> None:
        super().__init__(spark, path)
        self.width_s = width_s

    def append(self, df: DataFrame, batch_id: int) -> None:
        """Add the records of one batch; the same batch again replaces its own rows only. For ``foreachBatch``."""
        rows = partial_rows(df, self.width_s).withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows = rows.repartition("log_date")  # rollup rows, not records: one file a day and batch
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_date", "batch_id").parquet(f"{self.path}/open")

    def days(self) -> list[date]:
        """The days that have rows."""
        names = {n for home in ("open", "closed") for n in self.children(home) if n.startswith("log_date=")}
        return sorted(date.fromisoformat(n[9:]) for n in names)

    def closed(self) -> dict[date, int]:
        """The merged days and the last batch in each."""
        days = [n[9:] for n in self.children("closed") if n.startswith("log_date=")]
        found = {date.fromisoformat(d): Folder(self.spark, f"{self.path}/closed/log_date={d}").numbers("upto") for d in days}
        return {d: upto[-1] for d, upto in found.items() if upto}

    def read(self, start: date | None = None, upto: int | None = None) -> DataFrame:
        """Partial rows from the day ``start`` on, those of merged days once, of batches up to ``upto``; prunes days."""
        parts, closed = [], self.closed()
        if self.children("open"):
            rows = self.spark.read.schema(f"{SCHEMA}, batch_id long").parquet(f"{self.path}/open")
            for day, last in closed.items():  # days of the retention
                rows = rows.filter((F.col("log_date") != F.lit(day)) | (F.col("batch_id") > last))
            parts.append((rows if upto is None else rows.filter(F.col("batch_id") <= upto)).select(*_COLUMNS))
        if files := [f"{self.path}/closed/log_date={d.isoformat()}/upto={n}" for d, n in closed.items() if start is None or d >= start]:
            parts.append(self.spark.read.schema(SCHEMA).option("basePath", f"{self.path}/closed").parquet(*files).select(*_COLUMNS))
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return out.filter(F.col("log_date") >= F.lit(start)) if start else out

    def compact(self, day: date, upto: int) -> None:
        """Merge the rows of ``day`` of all batches up to ``upto``, which must be done; later ones stay as they are.

        The merged rows count from the moment they are complete, and their batches no more, so a call that is stopped
        anywhere, and a batch that is retried afterwards, change no total.
        """
        if self.closed().get(day, -1) >= upto:
            return
        rows = self.read(day, upto).filter(F.col("log_date") == F.lit(day))
        home = f"closed/log_date={day.isoformat()}"
        merged(rows, "bucket_us", "service_name").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{home}/upto={upto}")
        for child in self.children(home):
            if child.startswith("upto=") and int(child[5:]) < upto:
                self.remove(f"{home}/{child}")
        for child in self.children(f"open/log_date={day.isoformat()}"):
            if child.startswith("batch_id=") and int(child[9:]) <= upto:
                self.remove(f"open/log_date={day.isoformat()}/{child}")

    # --- reports ---

    def buckets(self, since_us: int, until_us: int, *keys: str) -> DataFrame:
        """Merged rows per ``keys`` of the whole buckets that begin in the half-open span."""
        start = datetime.fromtimestamp(since_us // MICROS, timezone.utc).date()
        rows = self.read(start).filter((F.col("bucket_us") >= since_us) & (F.col("bucket_us") < until_us))
        return merged(rows, *keys)

    def timeline(self, until_us: int, hours: int = 24) -> DataFrame:
        """Zero-filled buckets of the last hours: from the bucket of ``until_us - hours`` to that of ``until_us``, both whole."""
        step = self.width_s * MICROS
        low = until_us - hours * 3600 * MICROS
        per = self.buckets(low - low % step, until_us + 1, "bucket_us").select(
            "bucket_us", "total", "error_count", "anomaly_count", F.round(_mean(), 1).alias("avg_response_ms"),
            settled(_quantile(0.95), 1).alias("p95_response_ms"),
        )
        spine = bucket_spine(self.spark, F.lit(low), F.lit(until_us), self.width_s)
        return fill_spine(spine, per, ("total", "error_count", "anomaly_count", "avg_response_ms", "p95_response_ms"))

    def latency(self, since_us: int, until_us: int, keys: Sequence[str] = ()) -> DataFrame:
        """Latency profile and distinct addresses of whole buckets, per ``keys`` if any."""
        rows = self.buckets(since_us, until_us, *keys)
        spread = F.try_divide(F.col("sum_sq").cast("double"), F.col("timed")) - _mean() * _mean()
        return rows.select(
            *keys, "total", *[_quantile(q / 100).alias(f"p{q}_ms") for q in (50, 95, 99)], "min_ms", "max_ms",
            F.round(_mean(), 1).alias("avg_ms"), F.round(F.sqrt(F.greatest(spread, F.lit(0.0))), 1).alias("stddev_ms"),
            F.hll_sketch_estimate("addresses").alias("addresses"),
        )
