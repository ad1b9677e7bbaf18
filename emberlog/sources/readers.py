"""Inputs: the log topic as a stream, training files, and the stored history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.schema import TRAINING_REQUIRED, TRAINING_SCHEMA

MESSAGE_SCHEMA = "key string, value binary"


def log_topic(
    spark: SparkSession, broker: str, topic: str = "app-logs", from_start: bool = False, **options: str
) -> DataFrame:
    """Messages of the log topic: text key, raw bytes value, and their position."""
    reader = spark.readStream.format("kafka").options(
        **{
            "kafka.bootstrap.servers": broker, "subscribe": topic,
            "startingOffsets": "earliest" if from_start else "latest", **options,
        }
    )
    return reader.load().select(
        F.col("key").cast("string").alias("key"), "value", "timestamp", "partition", "offset"
    )


def message_files(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    """The same ``key, value`` stream from files."""
    return spark.readStream.format(format).schema(MESSAGE_SCHEMA).options(**options).load(path)


def training_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw training rows with a UTC ``timestamp``, its microseconds ``us`` and a tie column ``seq``, as training needs them.

    Fails when a needed column is absent, and as soon as a row without a readable timestamp is met. Rows are not sorted: the ordered
    operators find the time order themselves. ``seq`` is a hash of the row, so it depends on no file order; rows of one instant
    that share it are equal.
    """
    present = spark.read.option("header", True).csv(path).columns
    missing = [c for c in ("timestamp", *TRAINING_REQUIRED) if c not in present]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    fields = {f.name: f.dataType for f in TRAINING_SCHEMA}
    raw = spark.read.option("header", True).csv(path)
    typed = raw.select(*[F.col(c).cast(fields.get(c, "string")).alias(c) for c in present])
    said = F.coalesce(F.col("timestamp"), F.lit("none"))
    refused = F.raise_error(F.concat(F.lit("not a timestamp: "), said)).cast("timestamp")
    out = typed.withColumn("seq", F.xxhash64(*present)).withColumn("timestamp", F.coalesce(F.col("timestamp").try_cast("timestamp"), refused))
    return out.withColumn("us", F.unix_micros("timestamp"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
