"""Outlier detection by empirical cumulative distributions (Li et al. 2022)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.operators.models.forest import contamination_offset
from emberlog.operators.ordered import distribution, melt, running_totals
from emberlog.schema import CONTAMINATION, MODEL_FEATURES
from emberlog.session import stage

#: Most distinct values of a feature whose distribution is broadcast; those with more are merged in value order.
FEW_VALUES = 50_000


def skew_signs(df: DataFrame, features: Sequence[str]) -> dict[str, int]:
    """Sign of the skewness of each feature (0 for a constant one)."""
    row = df.agg(*[F.skewness(f).alias(f) for f in features]).first()
    return {f: int(np.sign(row[f])) if row[f] is not None and not np.isnan(row[f]) else 0 for f in features}


@dataclass(frozen=True)
class TailModel:
    """The stored distribution table ``(feature, value, n, at_most, at_least, total)`` and the skew signs."""

    features: tuple[str, ...]
    table: DataFrame
    total: int
    skew: Mapping[str, int]
    offset: float | None = None

    def _combine(self, left: Column, right: Column, skew: Column) -> Column:
        """Rarity of one feature value: the rarer tail, or both tails together when the feature is symmetric."""
        return F.when(skew == 0, left + right).otherwise(F.greatest(left, right))

    def score(self, df: DataFrame, name: str = "raw_score", seen: bool = False) -> DataFrame:
        """Add the sum of feature rarities, the same way for a table of any size.

        ``seen`` rows are part of the fitted table; any other row is counted into the tails itself, so a value
        beyond the fitted range stays finite, and so does a ``seen`` value that the table lacks. A null feature adds nothing.
        Features of few fitted values are looked up in place. For the others rows are numbered and stored; their values, with the
        numbers, are merged into the order of the fitted values once for all those features. The number is part of that order, so a
        value that most rows share is spread over buckets like any other.
        """
        own, few = 0 if seen else 1, self._few()
        if len(few) == len(self.features):
            return self._summed(df, few, name, own)
        rows, asks = self._numbered(df, few)
        zero = F.lit(0).cast("bigint")
        asks = asks.select("number", "value", F.lit(1).alias("turn"), "rid", zero.alias("upto"), zero.alias("less"))
        # A fitted value counts as reached before the rows that equal it, and as passed after them.
        turns = F.array(*[F.struct(F.lit(t).alias("turn"), u.alias("upto"), v.alias("less")) for t, u, v in ((0, F.col("n"), zero), (2, zero, F.col("n")))])
        known = self._many(few).select(self._number().alias("number"), "value", F.lit(-1).cast("bigint").alias("rid"), F.inline(turns)).select(*asks.columns)
        totals = {"at_most": F.col("upto"), "below": F.col("less")}
        merged = running_totals(known.unionByName(asks), ("number", "value", "turn", "rid"), totals, ("number",)).filter("turn = 1")
        rarity = self._rarity(F.col("at_most"), F.lit(self.total) - F.col("below"), own)
        return self._summed(rows, few, name, own, merged.select("rid", "number", rarity.alias("rarity")))

    def score_fitted(self, df: DataFrame, name: str = "raw_score") -> DataFrame:
        """``score(df, seen=True)`` for the very rows the table was fitted on: each value has a row in it, so one join finds them all."""
        few = self._few()
        if len(few) == len(self.features):
            return self._summed(df, few, name, 0)
        rows, asks = self._numbered(df, few)
        at_least = F.lit(self.total) - F.col("at_most") + F.col("n")
        table = self._many(few).select(self._number().alias("number"), "value", "at_most", at_least.alias("at_least"))
        rated = table.select(F.col("number").alias("__n"), F.col("value").alias("__v"), self._rarity(F.col("at_most"), F.col("at_least"), 0).alias("rarity"))
        found = asks.join(rated, (F.col("number") == F.col("__n")) & (F.col("value") == F.col("__v"))).select("rid", "number", "rarity")
        return self._summed(rows, few, name, 0, found)

    def _few(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By feature number the fitted values, ascending, and the rows at or below each, of features with up to ``FEW_VALUES`` of them."""
        counts = dict(self.table.groupBy("feature").count().collect())  # one row per feature
        names = [f for f in self.features if counts.get(f, 0) <= FEW_VALUES]
        # bounded by features x FEW_VALUES
        held = self.table.filter(F.col("feature").isin(names)).select("feature", "value", "at_most").toPandas()
        held = held.sort_values(["feature", "at_most"])
        parts = {f: held[held["feature"] == f] for f in names}
        return {i: (parts[f]["value"].to_numpy(np.float64), parts[f]["at_most"].to_numpy(np.int64)) for i, f in enumerate(self.features) if f in parts}

    def _many(self, few: Mapping[int, tuple]) -> DataFrame:
        return self.table.filter(F.col("feature").isin([f for i, f in enumerate(self.features) if i not in few]))

    def _number(self) -> Column:
        return F.create_map(*[F.lit(x) for i, f in enumerate(self.features) for x in (f, i)])[F.col("feature")]

    def _numbered(self, df: DataFrame, few: Mapping[int, tuple]) -> tuple[DataFrame, DataFrame]:
        """Rows with a stored number, and their values of features that are not among the ``few``: ``rid, number, value``."""
        rows = stage(df.withColumn("__rid", F.monotonically_increasing_id()), "rows")
        pairs = F.array(*[F.struct(F.lit(i).alias("number"), F.col(f).cast("double").alias("value")) for i, f in enumerate(self.features) if i not in few])
        return rows, rows.select(F.col("__rid").alias("rid"), F.inline(pairs)).filter(F.col("value").isNotNull())

    def _rarity(self, at_most: Column, at_least: Column, own: int, skew: Column | None = None) -> Column:
        skew = F.create_map(*[F.lit(x) for i, f in enumerate(self.features) for x in (i, self.skew[f])])[F.col("number")] if skew is None else skew
        total = F.lit(self.total) + own
        return self._combine(-F.log(F.greatest(at_most + own, F.lit(1)) / total), -F.log(F.greatest(at_least + own, F.lit(1)) / total), skew)

    def _looked_up(self, df: DataFrame, few: Mapping[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
        """Add ``__counts`` with ``m<i>`` and ``l<i>``, the fitted rows at or below and those below the value of feature ``i`` (anything for a null)."""
        # bounded by features x FEW_VALUES
        shared = df.sparkSession.sparkContext.broadcast({i: (values, np.r_[0, at_most]) for i, (values, at_most) in few.items()})
        numbers = list(few)

        @F.pandas_udf(", ".join(f"m{i} long, l{i} long" for i in numbers))
        def counts(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            for columns in batches:
                columns = (columns,) if isinstance(columns, pd.Series) else columns
                out = {}
                for i, c in zip(numbers, columns, strict=True):
                    values, upto = shared.value[i]
                    x = c.to_numpy(np.float64)
                    out[f"m{i}"], out[f"l{i}"] = upto[np.searchsorted(values, x, "right")], upto[np.searchsorted(values, x, "left")]
                yield pd.DataFrame(out)

        return df.withColumn("__counts", counts(*[F.col(self.features[i]).cast("double") for i in numbers]))

    def _summed(self, rows: DataFrame, few: Mapping[int, tuple], name: str, own: int, rated: DataFrame | None = None) -> DataFrame:
        # one value a feature, added in the order of the features, so that equal rows score equally
        many = [i for i in range(len(self.features)) if i not in few]
        if rated is not None:
            parts = rated.groupBy("rid").agg(*[F.max(F.when(F.col("number") == i, F.col("rarity"))).alias(f"__r{i}") for i in many])
            rows = rows.join(parts, F.col("__rid") == F.col("rid"), "left").drop("__rid", "rid")
        if few:
            rows = self._looked_up(rows, few)
        sum_ = F.lit(0.0)
        for i, f in enumerate(self.features):
            if i in few:
                at_most, below = F.col(f"__counts.m{i}"), F.col(f"__counts.l{i}")
                rarity = F.when(F.col(f).isNotNull(), self._rarity(at_most, F.lit(self.total) - below, own, F.lit(self.skew[f])))
            else:
                rarity = F.col(f"__r{i}")
            sum_ = sum_ + F.coalesce(rarity, F.lit(0.0))
        return rows.withColumn(name, sum_).drop("__counts", *[f"__r{i}" for i in many])

    def decide(self, df: DataFrame) -> DataFrame:
        if self.offset is None:
            raise ValueError("the model has no decision offset yet")
        out = self.score(df, "__raw").withColumn("anomaly_score", F.col("__raw") - F.lit(self.offset)).drop("__raw")
        return out.withColumn("is_anomaly", F.col("anomaly_score") > 0)


def fit_ecod(
    df: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    contamination: float = CONTAMINATION,
) -> TailModel:
    table = stage(distribution(melt(df, features)), "tails")
    model = TailModel(tuple(features), table, df.count(), skew_signs(df, features))
    offset = contamination_offset(model.score_fitted(df), "raw_score", contamination)
    return TailModel(model.features, table, model.total, model.skew, offset)
