"""Histogram-based outlier score (Goldstein, Dengel 2012) as plain column expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.operators.models.forest import contamination_offset
from emberlog.operators.ordered import melt
from emberlog.schema import CONTAMINATION, MODEL_FEATURES


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the upper edge belongs to the last bin. Outside the range it runs below 0 or above."""
    raw = F.floor((value - low) * bins / (high - low)).cast("int")
    return F.when(value == high, F.lit(bins - 1)).otherwise(raw)


def feature_ranges(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Lower and upper edge per feature; a constant feature gets a range of width one around it."""
    long = melt(df, features)
    flat = F.col("a") == F.col("b")
    return long.groupBy("feature").agg(F.min("value").alias("a"), F.max("value").alias("b")).select(
        "feature",
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("low"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("high"),
    )


def histograms(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, bins: int = 10) -> DataFrame:
    """Non-empty bins ``(feature, bin, n, low, high, total)`` of the equal-width histograms."""
    # One row per feature name.
    ranges = F.broadcast(feature_ranges(df, features))
    binned = melt(df, features).join(ranges, "feature").withColumn(
        "bin", _bin(F.col("value"), F.col("low"), F.col("high"), bins)
    )
    counts = binned.groupBy("feature", "low", "high", "bin").agg(F.count("*").alias("n"))
    totals = F.broadcast(counts.groupBy("feature").agg(F.sum("n").alias("total")))
    return counts.join(totals, "feature").select("feature", "bin", "n", "low", "high", "total")


@dataclass(frozen=True)
class Histograms:
    """Bin densities per feature; ``offset`` is the decision threshold."""

    features: tuple[str, ...]
    bins: int
    alpha: float
    tolerance: float
    low: Mapping[str, float]
    high: Mapping[str, float]
    density: Mapping[str, tuple[float, ...]]
    offset: float | None = None

    def _feature_score(self, name: str) -> Column:
        value, low, high = F.col(name).cast("double"), F.lit(self.low[name]), F.lit(self.high[name])
        scores = [math.log2(d + self.alpha) for d in self.density[name]]
        worst, reach = min(scores), self.tolerance * (self.high[name] - self.low[name]) / self.bins
        table = F.array(*[F.lit(s) for s in scores])
        inside = F.get(table, _bin(value, low, high, self.bins))
        below = F.when(low - value <= reach, F.lit(scores[0])).otherwise(F.lit(worst))
        above = F.when(value - high <= reach, F.lit(scores[-1])).otherwise(F.lit(worst))
        return -F.when(value < low, below).when(value > high, above).otherwise(inside)

    def score(self, df: DataFrame, name: str = "raw_score") -> DataFrame:
        total = F.lit(0.0)
        for f in self.features:
            total = total + self._feature_score(f)
        return df.withColumn(name, total)

    def decide(self, df: DataFrame) -> DataFrame:
        if self.offset is None:
            raise ValueError("the model has no decision offset yet")
        out = self.score(df, "__raw").withColumn("anomaly_score", F.col("__raw") - F.lit(self.offset)).drop("__raw")
        return out.withColumn("is_anomaly", F.col("anomaly_score") > 0)


def fit_hbos(
    df: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    bins: int = 10,
    alpha: float = 0.1,
    tolerance: float = 0.5,
    contamination: float = CONTAMINATION,
) -> Histograms:
    rows = histograms(df, features, bins).collect()  # features x bins rows
    low = {r["feature"]: r["low"] for r in rows}
    high = {r["feature"]: r["high"] for r in rows}
    counts = {f: [0] * bins for f in features}
    total = {r["feature"]: r["total"] for r in rows}
    for r in rows:
        counts[r["feature"]][r["bin"]] = r["n"]
    density = {f: tuple(c * bins / (total[f] * (high[f] - low[f])) for c in counts[f]) for f in features}
    model = Histograms(tuple(features), bins, alpha, tolerance, low, high, density)
    offset = contamination_offset(model.score(df), "raw_score", contamination)
    return Histograms(tuple(features), bins, alpha, tolerance, low, high, density, offset)
