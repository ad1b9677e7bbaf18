"""Leading-edge throttle: a row passes when its key last passed at least one period ago.

Whether a row passes depends on the rows that passed before it, so a plain window cannot express it and one
ordered scan per key would put a hot key into one task. Instead every (key, bucket of the time order) works out
on its own where the chain would leave the bucket for each place it can enter it: only at the rows of the first
period of the bucket, or the first row after. These jumps are composed by doubling, so the buckets that a chain
enters are known after as many rounds as their number has binary digits. The rounds are joins on (key, place): even where
traffic is so dense that every row of a key is such a place, no task gets more than its share. Afterwards all
buckets emit their rows independently.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.operators.ordered import running_totals, split_order
from emberlog.session import stage

_NEVER = np.iinfo(np.int64).min // 4


def _entries_to_exits(us: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row where a chain can enter this sorted block: its instant and the last instant it passes."""
    following = np.searchsorted(us, us + period, side="left")
    last = np.where(following < len(us), following, np.arange(len(us)))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    count = min(int(np.searchsorted(us, us[0] + period, side="left")) + 1, len(us))
    return us[:count], us[last[:count]]


def _passing(us: np.ndarray, period: int, last: int) -> list[int]:
    picked, at = [], int(np.searchsorted(us, last + period, side="left"))
    while at < len(us):
        picked.append(at)
        at = int(np.searchsorted(us, us[at] + period, side="left"))
    return picked


def _named(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__s_{k}" for k in keys})


def _same(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys]


def _starts(steps: DataFrame, keys: list[str], period: int) -> DataFrame:
    """Where each chain enters each of its buckets, ``(*keys, bucket, last_us)``: the first row a period after ``last_us`` passes there.

    ``steps`` holds entries and exits by bucket; an entry in bucket -1 stands for rows that passed before. The entry that follows an
    exit is found by its rank: the entries of the key before ``exit + period``, counted for all by one running total.
    """
    steps = stage(steps, "steps")
    point = [*keys, "bucket", "entry"]
    is_row = F.lit(1).cast("long")
    rows = steps.select(*point, F.col("entry").alias("at"), is_row.alias("kind"))
    asks = steps.select(*point, (F.col("exit") + F.lit(period)).alias("at"), (is_row - 1).alias("kind"))
    counted = stage(running_totals(stage(rows.unionByName(asks), "events"), ("at", "kind"), {"place": F.col("kind")}, keys), "places")
    place = counted.filter("kind = 1").drop("at", "kind")
    follows = counted.filter("kind = 0").select(*point, (F.col("place") + 1).alias("next"))
    placed = stage(place.join(_named(follows, point), _same(point)).drop(*[f"__s_{c}" for c in point]), "places")

    # The first place of a key begins its chain; jump leads 2^k places of the chain on, as far as there are places.
    spot = [*keys, "place"]
    reached = placed.filter("place = 1").select(*spot)
    beyond = placed.select(*spot).withColumnRenamed("place", "next")
    jump = stage(placed.select(*spot, "next").join(_named(beyond, [*keys, "next"]), _same([*keys, "next"]), "left_semi"), "jump")
    while True:
        further = stage(reached.join(_named(jump, spot), _same(spot)).select(*keys, F.col("next").alias("place")), "further")
        if further.isEmpty():
            break
        reached = reached.unionByName(further)
        on = _named(jump.withColumnRenamed("next", "beyond"), spot)
        jump = jump.withColumnsRenamed({"place": "from", "next": "place"}).join(on, _same(spot)).select(*keys, F.col("from").alias("place"), F.col("beyond").alias("next"))
        jump = stage(jump, "jump")
    entered = placed.join(_named(reached, spot), _same(spot), "left_semi").filter("bucket >= 0")
    return entered.select(*keys, "bucket", (F.col("entry") - F.lit(period)).alias("last_us"))


def throttle(
    df: DataFrame,
    keys: Sequence[str],
    instant: str,
    tie: str,
    period_us: int,
    carried: DataFrame | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """The rows of ``df`` that pass. ``carried`` holds ``(*keys, last_us)`` of earlier passes, none after a row of ``df``.

    ``(instant, tie)`` must identify a row within its key; ``instant`` is microseconds. A null key is a key of its own.
    """
    if period_us <= 0:
        raise ValueError("period must be positive")
    keys = list(keys)
    # Only the first row of an instant can pass. Stored, because each step below reads it.
    firsts = stage(df.groupBy(*keys, F.col(instant).alias("us")).agg(F.min(tie).alias("tie")), "firsts")
    splits = split_order(firsts, ("us", *keys), rows_per_bucket)
    tagged = splits.tag(firsts, "bucket")

    key_fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    step_schema = T.StructType(
        [*key_fields, T.StructField("bucket", T.IntegerType()), T.StructField("entry", T.LongType()),
         T.StructField("exit", T.LongType())]
    )

    def transfer(block: pd.DataFrame) -> pd.DataFrame:
        us = np.sort(block["us"].to_numpy(np.int64))
        entry, leave = _entries_to_exits(us, period_us)
        out = pd.DataFrame({"entry": entry, "exit": leave})
        for k in keys:
            out[k] = block[k].iloc[0]
        out["bucket"] = block["bucket"].iloc[0]
        return out[[*keys, "bucket", "entry", "exit"]]

    steps = tagged.select(*keys, "bucket", "us").groupBy(*keys, "bucket").applyInPandas(transfer, step_schema)
    if carried is not None:
        steps = steps.unionByName(
            carried.select(
                *keys, F.lit(-1).alias("bucket"), F.lit(int(_NEVER) // 2).alias("entry"), F.col("last_us").alias("exit")
            )
        )

    if splits.buckets == 1 and carried is None:
        starts = tagged.select(*keys, "bucket").distinct().withColumn("last_us", F.lit(int(_NEVER)))  # nothing to compose
    else:
        starts = _starts(steps, keys, period_us)

    pass_schema = T.StructType(
        [*key_fields, T.StructField("us", T.LongType()), T.StructField("tie", df.schema[tie].dataType)]
    )

    def emit(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("us")
        rows = _passing(block["us"].to_numpy(np.int64), period_us, int(block["last_us"].iloc[0]))
        return block.iloc[rows][[*keys, "us", "tie"]]

    passed = (
        tagged.join(_named(starts.select(*keys, "bucket", "last_us"), (*keys, "bucket")), _same((*keys, "bucket")))
        .groupBy(*keys, "bucket")
        .applyInPandas(emit, pass_schema)
        .select(*[F.col(k).alias(f"__p_{k}") for k in keys], F.col("us").alias("__p_us"), F.col("tie").alias("__p_tie"))
    )
    same = [F.col(k).eqNullSafe(F.col(f"__p_{k}")) for k in keys]
    same += [F.col(instant) == F.col("__p_us"), F.col(tie) == F.col("__p_tie")]
    return df.join(passed, same, "left_semi")
