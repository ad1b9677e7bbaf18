"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberlog.session import stage

__all__ = ["components", "mix", "ranked", "read", "slices", "stage", "text_key"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_key() -> Column:
    """With ``doc_id`` it names a row by content, so repeated rows share one decision and joins never multiply them."""
    return F.xxhash64(F.col("text"), F.length("text"))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Keyed finaliser over unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def slices(texts: list[str | None], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` characters each, so that a batch of long texts stays small in memory."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 1
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def ranked(df: DataFrame, groups: list[str], order: list[str], name: str, rows: int) -> DataFrame:
    """Add the gapless rank from 0 within each group, for groups of any size.

    A group is dealt over about the square root of ``rows`` buckets; ranks are the rows of the buckets before plus the
    place in the own bucket. Null groups form one group. Equal rows get different ranks in any order.
    """
    buckets = max(1, math.isqrt(max(rows, 1)))
    df = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    keys = [*groups, "_b"]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    counts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_before")
    inner = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("_r", F.row_number().over(inner) - 1)
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = df.join(counts, match, "inner").withColumn(name, (F.col("_r") + F.col("_before")).cast("long"))
    return joined.drop("_r", "_b", "_before", *[f"_k_{k}" for k in keys])


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """Connected components of the links ``a``, ``b`` (longs): one row ``node``, ``root`` per linked node, root the least member.

    Each round every node and its root take the least root among its neighbours and then their root's root, so parts
    merge in few rounds; rounds are written to the shared folder and end when nothing changes. Self-links and repeats are harmless.
    """
    links = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    links = stage(links, "links")
    roots = stage(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "roots")
    for _ in range(most):
        near = links.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        seen = roots.join(near, "node")
        # a node's find also moves its root, so whole parts join at once
        told = seen.select("node", "near").union(seen.select(F.col("root").alias("node"), "near")).groupBy("node").agg(F.min("near").alias("near"))
        step = roots.join(told, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        up = step.select(F.col("node").alias("up"), F.col("root").alias("above"))
        step = step.join(up, F.col("root") == F.col("up"), "left").select("node", F.coalesce(F.least("root", "above"), "root").alias("root"), "old")
        step = stage(step, "roots")
        roots = step.drop("old")
        if step.filter(F.col("root") != F.col("old")).isEmpty():
            return roots
    raise RuntimeError(f"components did not settle in {most} rounds")
