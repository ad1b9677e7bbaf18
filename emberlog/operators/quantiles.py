"""Exact quantiles of real values without a sort of all of them.

A mergeable sketch brackets each quantile between two values. The rows below the bracket are counted, and only the rows inside it,
some thousandths of all, are counted by value and ordered. A bracket that still holds many rows is narrowed by another sketch of its
rows. The sketch decides how much is read and ordered, never the result: a bracket counts as found only if the counts prove it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.session import stage

#: Steps of the sketch's grid, and its accuracy: an error of a tenth of a step.
GRID, ACCURACY = 500, 5_000
#: Most groups whose brackets are broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000
#: Rows of a bracket that may be ordered in one task.
MOST = 1_000_000


def _inside(i: int) -> Column:
    """Whether ``v`` lies in bracket ``i``; a null end is open."""
    low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
    return (low.isNull() | (F.col("v") >= low)) & (high.isNull() | (F.col("v") <= high))


def _held(brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored; without keys it is one row, which comes to the driver instead."""
    return stage(brackets, "brackets") if keys else brackets.sparkSession.createDataFrame(brackets.collect(), brackets.schema)


def _with_brackets(values: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    side = brackets.withColumnsRenamed({k: f"__b_{k}" for k in keys})
    if not keys:
        return values.crossJoin(F.broadcast(side))  # one row
    if brackets.count() <= BROADCAST_GROUPS:  # a row is the keys and a few numbers for each quantile
        side = F.broadcast(side)
    return values.join(side, [F.col(k).eqNullSafe(F.col(f"__b_{k}")) for k in keys])


def _narrowed(values: DataFrame, brackets: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Brackets two to four steps of the grid wide, with the rows ``below`` and ``inside`` them; a bracket that proves wrong stays as it was."""
    grid = [j / GRID for j in range(GRID + 1)]
    rows = _with_brackets(values, brackets, keys)
    sketches = rows.groupBy(*keys).agg(*[F.percentile_approx(F.when(_inside(i), F.col("v")), grid, ACCURACY).alias(f"grid{i}") for i in range(n)])
    known = brackets.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    joined = sketches.join(known, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]) if keys else sketches.crossJoin(F.broadcast(known))
    ends = []
    for i in range(n):
        share = (F.col(f"k{i}") - F.col(f"below{i}")) / F.greatest(F.col(f"inside{i}") - 1, F.lit(1)) * GRID
        first, last = F.floor(share).cast("int") - 1, F.ceil(share).cast("int") + 2
        ends += [
            F.when(first > 0, F.get(f"grid{i}", first)).otherwise(F.col(f"lo{i}")).alias(f"lo{i}"), F.when(last < GRID, F.get(f"grid{i}", last)).otherwise(F.col(f"hi{i}")).alias(f"hi{i}"),
            F.col(f"lo{i}").alias(f"was_lo{i}"), F.col(f"hi{i}").alias(f"was_hi{i}"), F.col(f"below{i}").alias(f"was_below{i}"), F.col(f"inside{i}").alias(f"was_inside{i}"), f"k{i}",
        ]
    tried = _held(joined.select(*keys, "total", *ends), keys)
    fields = [c for c in tried.columns if c not in keys]
    rows = _with_brackets(values, tried, keys)
    counts = []
    for i in range(n):
        low = F.col(f"lo{i}")
        counts += [F.count_if(low.isNotNull() & (F.col("v") < low)).alias(f"below{i}"), F.count_if(_inside(i)).alias(f"inside{i}")]
    counted = rows.groupBy(*keys).agg(*[F.first(f).alias(f) for f in fields], *counts)
    out = []
    for i in range(n):
        k, below = F.col(f"k{i}"), F.col(f"below{i}")
        proven = (below <= k) & (F.least(k + 1, F.col("total") - 1) < below + F.col(f"inside{i}"))
        out += [F.when(proven, F.col(c + str(i))).otherwise(F.col(f"was_{c}{i}")).alias(c + str(i)) for c in ("lo", "hi", "below", "inside")] + [f"k{i}"]
    return _held(counted.select(*keys, "total", *out), keys)


def exact_percentiles(df: DataFrame, column: str, probabilities: Sequence[float], keys: Sequence[str] = (), most: int | None = None) -> DataFrame:
    """``(*keys, total, q0, q1, ...)``: linearly interpolated quantiles at ``(n - 1) * p``, exact for any number of distinct values.

    Nulls don't count; a group without values has nulls. ``df`` is read once for the counts, twice for each narrowing (as a rule
    none up to ``most`` rows a group, one up to a hundred times as many) and once for the brackets: pass a stored table.
    """
    keys, n, most = list(keys), len(probabilities), most or MOST
    every = df.select(*keys, F.col(column).cast("double").alias("v"))
    values = every.filter(F.col("v").isNotNull())
    sizes = every.groupBy(*keys).agg(F.count("v").alias("total"))
    start = [c for i, p in enumerate(probabilities) for c in (
        F.lit(None).cast("double").alias(f"lo{i}"), F.lit(None).cast("double").alias(f"hi{i}"), F.lit(0).cast("long").alias(f"below{i}"), F.col("total").alias(f"inside{i}"),
        F.floor((F.col("total") - 1) * F.lit(float(p))).alias(f"k{i}"),
    )]
    brackets = _held(sizes.select(*keys, "total", *start), keys)
    groups = brackets.select(*[F.col(k).alias(f"__g_{k}") for k in keys], "total")
    widest = F.max(F.greatest(*[F.col(f"inside{i}") for i in range(n)])) if n > 1 else F.max("inside0")
    held = brackets.agg(widest).first()[0] or 0
    while held > most:
        tighter = _narrowed(values, brackets, keys, n)
        now = tighter.agg(widest).first()[0]
        if now >= held:  # equal values fill the bracket: they are one row once counted by value
            break
        brackets, held = tighter, now

    rows = _with_brackets(values, brackets, keys)
    numbers = F.array(*[F.when(_inside(i), F.lit(i)) for i in range(n)])
    counted = rows.select(*keys, "v", F.explode(F.array_compact(numbers)).alias("i")).groupBy(*keys, "i", "v").agg(F.count("*").alias("n"))
    order = Window.partitionBy(*keys, "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = _with_brackets(counted.withColumn("upto", F.sum("n").over(order)), brackets, keys)
    picks = []
    for i, p in enumerate(probabilities):
        k, at = F.col(f"k{i}"), F.col("upto") + F.col(f"below{i}")
        for side, rank in (("a", k), ("b", F.least(k + 1, F.col("total") - 1))):
            picks.append(F.max(F.when((F.col("i") == i) & (at - F.col("n") <= rank) & (rank < at), F.col("v"))).alias(f"{side}{i}"))
    found = placed.groupBy(*keys).agg(*picks)
    if keys:
        found = groups.join(found, [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys], "left").select(*[F.col(f"__g_{k}").alias(k) for k in keys], "total", *[c for c in found.columns if c not in keys])
    else:
        found = groups.crossJoin(F.broadcast(found))  # one row each
    out = []
    for i, p in enumerate(probabilities):
        place = (F.col("total") - 1) * F.lit(float(p))
        out.append((F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * (place - F.floor(place))).alias(f"q{i}"))
    return found.select(*keys, "total", *out)
