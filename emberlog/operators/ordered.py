"""Computations over one global order, spread over the cluster.

A window without a partition key puts every row into one task, and blocks of fixed length put a burst into
one task. Here the order is cut at sampled *key values*, as a distributed sort does: each bucket is a range of
the whole order key, so buckets have about equal row counts even when a third of all rows share one minute or
one instant. The sample decides the balance only, never the result. Where buckets are so small that their cut points
grow with the rows, the driver holds few of them; the rest are a stored table that is merged into the order.

A running total is then the total of the earlier buckets plus the running total inside the own bucket; ranks,
trailing windows, running counts per key, exact quantiles and empirical distributions all reduce to it.

The input is read for its size, for the sample, for the bucket totals and for the result: pass a stored table, or
``session.stage`` an expensive plan first. All but the last pass read the order columns and the summed values only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.session import stage

ROWS_PER_BUCKET = 1_000_000
SAMPLES_PER_BUCKET = 32
MIN_ROWS_TO_SPLIT = 20_000
MAX_TREE_BOUNDS = 63
#: Most buckets whose cut points the driver picks, unless a bucket of ROWS_PER_BUCKET rows asks for more.
MAX_DRIVER_BUCKETS = 512

_BUCKET = "__bucket"
_ENTERS = "__enters"
_ROW = "__row"
_PART = "__part"
_CUT = "__cut"


def _bucket_count(rows: int, parallelism: int, rows_per_bucket: int | None) -> int:
    if rows_per_bucket is not None:
        wanted = math.ceil(rows / rows_per_bucket)
    else:
        # Several buckets per core even out their hashing to tasks.
        wanted = max(math.ceil(rows / ROWS_PER_BUCKET), min(3 * parallelism, rows // MIN_ROWS_TO_SPLIT))
    return max(1, wanted)


@dataclass(frozen=True)
class OrderSplits:
    """Cut points of a global order over ``columns`` (ascending, no nulls)."""

    columns: tuple[str, ...]
    bounds: tuple[tuple, ...]
    types: tuple[T.DataType, ...]
    #: Further cut points, stored with the range of ``bounds`` they lie in, and the first bucket of each range.
    fine: DataFrame | None = None
    starts: tuple[int, ...] = ()
    fine_count: int = 0

    @property
    def buckets(self) -> int:
        return len(self.bounds) + 1 + self.fine_count

    def _at_or_after(self, bound: Sequence[Column]) -> Column:
        """Whether the row's key is at or after ``bound``, compared column by column."""
        *first, last = [(F.col(c), v) for c, v in zip(self.columns, bound)]
        out = last[0] >= last[1]
        for column, value in reversed(first):
            out = (column > value) | ((column == value) & out)
        return out

    def _decision(self, low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        bound = [F.lit(v).cast(t) for v, t in zip(self.bounds[middle], self.types)]
        return F.when(self._at_or_after(bound), self._decision(middle + 1, high)).otherwise(self._decision(low, middle))

    def _search(self) -> Column:
        """The number of ``bounds`` at or below the key, by binary search.

        A few become a compiled decision tree; many are searched in constant arrays, which no row carries along.
        """
        if len(self.bounds) <= MAX_TREE_BOUNDS:
            return self._decision(0, len(self.bounds))
        arrays = [F.lit([b[i] for b in self.bounds]).cast(T.ArrayType(t)) for i, t in enumerate(self.types)]

        def halve(state: Column, _: Column) -> Column:
            low, high = state["low"], state["high"]
            middle = F.shiftright(low + high, 1)
            right = self._at_or_after([F.get(a, middle) for a in arrays])
            return F.when(
                low < high,
                F.struct(
                    F.when(right, middle + 1).otherwise(low).alias("low"),
                    F.when(right, high).otherwise(middle).alias("high"),
                ),
            ).otherwise(state)

        steps = math.ceil(math.log2(len(self.bounds) + 1))
        start = F.struct(F.lit(0).alias("low"), F.lit(len(self.bounds)).alias("high"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["low"]

    def tag(self, df: DataFrame, name: str = _BUCKET) -> DataFrame:
        """Add the bucket of every row: the number of cut points at or below its key.

        Stored cut points enter the order of their range as rows, and each row counts those that it has passed.
        """
        if self.fine is None:
            return df.withColumn(name, self._search())
        rows = df.withColumns({_PART: self._search(), _CUT: F.lit(0)})
        merged = rows.unionByName(self.fine.withColumn(_CUT, F.lit(1)), allowMissingColumns=True)
        passed = Window.partitionBy(_PART).orderBy(*self.columns, F.desc(_CUT)).rowsBetween(Window.unboundedPreceding, 0)
        first = F.get(F.lit(list(self.starts)), F.col(_PART))
        numbered = merged.withColumn(name, (first + F.sum(_CUT).over(passed)).cast("int"))
        return numbered.filter(F.col(_CUT) == 0).drop(_PART, _CUT)


def _cut(columns: Sequence[str], types: Sequence[T.DataType], sample: list[tuple], n: int) -> OrderSplits:
    sample.sort()
    picks = {sample[i * len(sample) // n] for i in range(1, n)} if sample else set()
    return OrderSplits(tuple(columns), tuple(sorted(picks)), tuple(types))


def _sample_keys(keys: DataFrame, n: int, rows: int) -> list[tuple]:
    """About SAMPLES_PER_BUCKET rows per bucket, whatever the number of rows."""
    fraction = min(1.0, n * SAMPLES_PER_BUCKET / max(rows, 1))
    return [tuple(r) for r in keys.sample(fraction=fraction, seed=17).collect()]


def _driver_buckets(df: DataFrame, rows: int) -> int:
    """Most buckets whose sample comes to the driver."""
    return max(MAX_DRIVER_BUCKETS, _bucket_count(rows, df.sparkSession.sparkContext.defaultParallelism, None))


def _finely_cut(keys: DataFrame, n: int, rows: int) -> OrderSplits:
    """Cut points for ``n`` buckets of about ``rows / n`` keys, however many: the driver sees those of some wide ranges only.

    The sample of all others is put in order range by range, and every so many keys one becomes a cut point.
    """
    columns, types = keys.columns, [f.dataType for f in keys.schema.fields]
    wide = _bucket_count(rows, keys.sparkSession.sparkContext.defaultParallelism, None)
    outer = _cut(columns, types, _sample_keys(keys, wide, rows) if wide > 1 else [], wide)
    fraction = min(1.0, n * SAMPLES_PER_BUCKET / rows)
    step = max(1, int(fraction * rows / n))
    place = F.row_number().over(Window.partitionBy(_PART).orderBy(*columns))
    sample = outer.tag(keys.sample(fraction=fraction, seed=17), _PART).withColumn("__place", place)
    fine = stage(sample.filter(F.col("__place") % step == 0).drop("__place"), "cuts")
    per_range = dict(fine.groupBy(_PART).count().collect())  # one row per range
    starts, at = [], 0
    for i in range(len(outer.bounds) + 1):
        starts.append(at)
        at += 1 + per_range.get(i, 0)
    return OrderSplits(outer.columns, outer.bounds, outer.types, fine, tuple(starts), sum(per_range.values()))


def split_order(df: DataFrame, columns: Sequence[str], rows_per_bucket: int | None = None) -> OrderSplits:
    """Sample cut points for ``columns``; reads only these columns and brings a bounded sample to the driver."""
    keys = df.select(*columns)
    types = [f.dataType for f in keys.schema.fields]
    rows = keys.count()
    n = _bucket_count(rows, df.sparkSession.sparkContext.defaultParallelism, rows_per_bucket)
    if n > _driver_buckets(df, rows):
        return _finely_cut(keys, n, rows)
    return _cut(columns, types, _sample_keys(keys, n, rows) if n > 1 else [], n)


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    values: Mapping[str, Column],
    keys: Sequence[str] = (),
    splits: OrderSplits | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add inclusive running totals of ``values`` along ``order``, separately per ``keys``.

    ``order`` must identify a row within its key. A hot key is spread over the buckets it occurs in.
    """
    splits = splits or split_order(df, order, rows_per_bucket)
    names = list(values)
    tagged = splits.tag(df.withColumns({f"__v_{n}": values[n] for n in names}))
    group = [*keys, _BUCKET]
    inside = Window.partitionBy(*group).orderBy(_ROW, *order).rowsBetween(Window.unboundedPreceding, 0)
    tagged = tagged.withColumn(_ROW, F.lit(1))
    rows = tagged
    if splits.buckets > 1:
        # The total of the earlier buckets enters each group as a row in front of it, so that one shuffle on the
        # group serves the whole computation. Without keys this side has one row per bucket.
        earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        per_bucket = tagged.groupBy(*group).agg(*[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in names])
        before = per_bucket.select(
            *group, *[F.sum(f"__v_{n}").over(earlier).alias(f"__v_{n}") for n in names], F.lit(0).alias(_ROW)
        )
        rows = tagged.unionByName(before, allowMissingColumns=True)
    totals = rows.withColumns({n: F.sum(f"__v_{n}").over(inside) for n in names})
    return totals.filter(F.col(_ROW) == 1).drop(_BUCKET, _ROW, *[f"__v_{n}" for n in names])


def ranked(
    df: DataFrame, order: Sequence[str], name: str = "rank", rows_per_bucket: int | None = None
) -> DataFrame:
    """Add the 1-based position of every row in the global order."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, rows_per_bucket=rows_per_bucket)


def trailing_totals(
    df: DataFrame,
    instant: str,
    tie: str,
    width_us: int,
    values: Mapping[str, Column],
    keys: Sequence[str] = (),
    closed: bool = False,
    overall: Mapping[str, Column] | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add totals of ``values`` over the trailing time window of every row, itself included.

    The window is ``(t - width, t]``, or ``[t - width, t]`` when ``closed``. Rows of one instant count in
    ``tie`` order. Each row enters the total at its own instant and leaves it when the window has passed it,
    so one running total over entries and departures answers every window, however dense the burst.
    ``overall`` adds plain running totals along the same order in the same pass.
    """
    overall = dict(overall or {})
    lifetime = width_us + (1 if closed else 0)
    splits = _split_events(df, instant, tie, lifetime, rows_per_bucket)
    rows = df.withColumns(
        {**{f"__w_{n}": v for n, v in values.items()}, **{f"__o_{n}": v for n, v in overall.items()}}
    ).withColumn(_ENTERS, F.lit(1))
    departures = rows.select(
        *keys,
        (F.col(instant) + F.lit(lifetime)).alias(instant),
        F.col(tie),
        *[(-F.col(f"__w_{n}")).alias(f"__w_{n}") for n in values],
        F.lit(0).alias(_ENTERS),
    )
    events = rows.unionByName(departures, allowMissingColumns=True)
    sums = {**{n: F.col(f"__w_{n}") for n in values}, **{n: F.coalesce(f"__o_{n}", F.lit(0)) for n in overall}}
    totals = running_totals(events, splits.columns, sums, keys, splits)
    helpers = [f"__w_{n}" for n in values] + [f"__o_{n}" for n in overall]
    return totals.filter(F.col(_ENTERS) == 1).drop(_ENTERS, *helpers)


def _split_events(
    df: DataFrame, instant: str, tie: str, lifetime: int, rows_per_bucket: int | None
) -> OrderSplits:
    """Cut points for the entries and departures of ``df``, from a sample of its rows."""
    keys = df.select(instant, tie)
    instant_type, tie_type = (f.dataType for f in keys.schema.fields)
    rows = keys.count()
    n = _bucket_count(2 * rows, df.sparkSession.sparkContext.defaultParallelism, rows_per_bucket)
    if n > _driver_buckets(df, 2 * rows):
        moves = [(F.col(instant), 1), ((F.col(instant) + F.lit(lifetime)).cast(instant_type), 0)]
        both = [F.struct(at.alias(instant), F.lit(enters).alias(_ENTERS), F.col(tie)) for at, enters in moves]
        return _finely_cut(keys.select(F.inline(F.array(*both))), n, 2 * rows)
    sample = _sample_keys(keys, n, rows) if n > 1 else []
    events = [(us, 1, t) for us, t in sample] + [(us + lifetime, 0, t) for us, t in sample]
    return _cut((instant, _ENTERS, tie), (instant_type, T.IntegerType(), tie_type), events, n)


def trailing_rows(
    df: DataFrame, rank: str, depth: int, values: Mapping[str, Column], rows_per_block: int = 100_000
) -> DataFrame:
    """Add totals of ``values`` over the last ``depth`` rows of a dense 1-based rank, itself included.

    Blocks of the rank have equal size; the last ``depth - 1`` rows of a block are copied to the next one.
    """
    if depth > rows_per_block:
        raise ValueError("depth must not exceed rows_per_block")
    position = F.col(rank) - 1
    block = F.expr(f"(`{rank}` - 1) div {rows_per_block}")
    reaches_on = position % rows_per_block > rows_per_block - depth
    copied = (
        df.withColumns({f"__w_{n}": v for n, v in values.items()})
        .withColumn("__home", block)
        .withColumn(
            "__target",
            F.explode(
                F.when(reaches_on, F.array("__home", F.col("__home") + 1)).otherwise(F.array("__home"))
            ),
        )
    )
    frame = Window.partitionBy("__target").orderBy(rank).rowsBetween(-(depth - 1), 0)
    return (
        copied.withColumns({n: F.sum(f"__w_{n}").over(frame) for n in values})
        .filter(F.col("__target") == F.col("__home"))
        .drop("__home", "__target", *[f"__w_{n}" for n in values])
    )


def running_counts(
    df: DataFrame, key: str, instant: str, tie: str, name: str, rows_per_bucket: int | None = None
) -> DataFrame:
    """Number the rows of each key 1, 2, 3, ... in time order; a flooding key is spread over its buckets."""
    return running_totals(
        df, (instant, tie), {name: F.lit(1).cast("bigint")}, (key,), rows_per_bucket=rows_per_bucket
    )


def melt(df: DataFrame, columns: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Long form ``(feature, value)`` of numeric columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns])
    return df.select(F.inline(pairs))


def distribution(long: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """Empirical distribution of ``(feature, value)``: rows at or below and at or above each distinct value.

    Counts per value are combined before the shuffle; cumulative counts are running totals, so neither a
    frequent value nor a feature with as many values as rows ends in one task.
    """
    # Stored, because the cut points, the bucket totals and the running totals each read it.
    counts = stage(
        long.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("n")), "counts"
    )
    cum = running_totals(
        counts, ("feature", "value"), {"at_most": F.col("n")}, ("feature",), rows_per_bucket=rows_per_bucket
    )
    # One row per feature name.
    totals = F.broadcast(counts.groupBy("feature").agg(F.sum("n").alias("total")))
    return cum.join(totals, "feature").select(
        "feature", "value", "n", "at_most", (F.col("total") - F.col("at_most") + F.col("n")).alias("at_least"), "total"
    )


def exact_quantiles(
    long: DataFrame, probabilities: Sequence[float], rows_per_bucket: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles of every feature as columns ``q0, q1, ...`` in the order asked."""
    cdf = distribution(long, rows_per_bucket)
    aggs = []
    for i, p in enumerate(probabilities):
        k = (F.col("total") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(k)), ("hi", F.ceil(k))):
            hit = (F.col("at_most") - F.col("n") <= at) & (at < F.col("at_most"))
            aggs.append(F.max(F.when(hit, F.col("value"))).alias(f"{side}{i}"))
    picked = cdf.groupBy("feature").agg(F.max("total").alias("total"), *aggs)
    out = []
    for i, p in enumerate(probabilities):
        k = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append((low + (high - low) * (k - F.floor(k))).alias(f"q{i}"))
    return picked.select("feature", "total", *out)


def column_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float | None]:
    """Exact quantiles of one numeric column as Python numbers."""
    row = exact_quantiles(melt(df, [column]), probabilities).first()
    return [None] * len(probabilities) if row is None else [row[f"q{i}"] for i in range(len(probabilities))]
