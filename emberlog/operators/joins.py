"""Joins the log analytics need: lookups of checked size, time intervals, and zero-filled spines."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.schema import MICROS
from emberlog.session import stage

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
_BLOCK_US = 60 * MICROS


def sized(df: DataFrame, limit: int = BROADCAST_ROWS, name: str = "lookup") -> DataFrame:
    """Store a small-side candidate and mark it for broadcast only when its rows and its size as text are within limits.

    Beyond the limit it is left to a shuffle join, where adaptive execution splits hot keys.
    """
    stored = stage(df, name)
    width = F.length(F.to_json(F.struct("*")))
    rows, size = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(stored) if rows <= limit and size <= BROADCAST_BYTES else stored


@dataclass(frozen=True)
class Incident:
    """A named half-open span ``[start_us, end_us)``."""

    name: str
    start_us: int
    end_us: int


def recurring_incidents(
    spans: Iterable[tuple[str, int, int]], start_us: int, cycle_s: int, until_us: int
) -> list[Incident]:
    """Repeat ``(name, from_s, to_s)`` spans every ``cycle_s`` seconds from ``start_us`` up to ``until_us``."""
    out, base = [], start_us
    while base <= until_us:
        out += [Incident(n, base + lo * MICROS, base + hi * MICROS) for n, lo, hi in spans]
        base += cycle_s * MICROS
    return out


def _incident_table(spark: SparkSession, incidents: Sequence[Incident]) -> tuple[DataFrame, bool]:
    ordered = sorted(incidents, key=lambda i: i.start_us)
    if any(b.start_us < a.end_us for a, b in zip(ordered, ordered[1:])):
        raise ValueError("incidents overlap")
    rows = [(i.name, i.start_us, i.end_us) for i in ordered]
    blocks = sum((i.end_us - i.start_us) // _BLOCK_US + 2 for i in ordered)
    table = spark.createDataFrame(rows, "incident_name string, lo long, hi long").withColumn(
        "block", F.explode(F.sequence(F.expr(f"lo div {_BLOCK_US}"), F.expr(f"(hi - 1) div {_BLOCK_US}")))
    )
    return table, blocks <= BROADCAST_ROWS


def _within(df: DataFrame, instant: str, table: DataFrame) -> Column:
    row_block = F.expr(f"`{instant}` div {_BLOCK_US}")
    return (row_block == table["block"]) & (df[instant] >= table["lo"]) & (df[instant] < table["hi"])


def exclude_incidents(df: DataFrame, incidents: Sequence[Incident], instant: str = "us") -> DataFrame:
    """Rows outside every incident. The join is an equality on minute blocks, so it hashes instead of comparing all."""
    table, small = _incident_table(df.sparkSession, incidents)
    table = F.broadcast(table) if small else table
    return df.join(table, _within(df, instant, table), "left_anti")


def tag_incidents(
    df: DataFrame, incidents: Sequence[Incident], instant: str = "us", name: str = "incident"
) -> DataFrame:
    """Add the name of the incident each row falls in, or null."""
    table, small = _incident_table(df.sparkSession, incidents)
    table = F.broadcast(table) if small else table
    joined = df.join(table, _within(df, instant, table), "left")
    return joined.drop("block", "lo", "hi").withColumnRenamed("incident_name", name)


def bucket_spine(spark: SparkSession, start_us: Column, end_us: Column, width_s: int) -> DataFrame:
    """Every epoch-aligned bucket start ``bucket_us`` touching ``[start_us, end_us]``."""
    step = F.lit(width_s * MICROS)
    low, high = start_us - F.pmod(start_us, step), end_us - F.pmod(end_us, step)
    return spark.range(1).select(F.explode(F.sequence(low, high, step)).alias("bucket_us"))


def fill_spine(spine: DataFrame, per_bucket: DataFrame, zero: Sequence[str]) -> DataFrame:
    """Left-join per-bucket aggregates to the spine, with zeros where a bucket had no rows."""
    return spine.join(per_bucket, "bucket_us", "left").fillna(0, subset=list(zero))
