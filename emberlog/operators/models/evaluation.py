"""Labels, metrics, threshold sweeps and model selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.operators.joins import Incident, exclude_incidents
from emberlog.operators.models.forest import Forest
from emberlog.operators.ordered import melt
from emberlog.operators.quantiles import exact_percentiles
from emberlog.schema import CONTAMINATION_SWEEP, LEVELS

# Incident spans in seconds from the start of the data set; the last one is a test case only.
INCIDENT_SPANS = (
    ("payment_outage", 300, 480),
    ("latency_spike", 720, 840),
    ("db_failure", 1200, 1320),
    ("ip_flood", 1500, 1680),
)
TRAINING_EXCLUSIONS = INCIDENT_SPANS[:3]


def truth(level: Column, status: Column) -> Column:
    """Evaluation label: an error level, or a status of 400 or more."""
    return level.isin("ERROR", "CRITICAL") | (F.coalesce(status, F.lit(0)) >= 400)


def clean_training(df: DataFrame, incidents: Sequence[Incident], instant: str = "us") -> DataFrame:
    """Training rows outside the known incidents."""
    return exclude_incidents(df, incidents, instant)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    return counts.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": f1,
            "f1_macro": (f1 + _ratio(2 * tn, 2 * tn + fp + fn)) / 2,
            "flagged_pct": _ratio(tp + fp, tp + fp + fn + tn),
            "fp_rate": _ratio(fp, fp + tn),
        }
    )


def _confusion(actual: Column, flagged: Column) -> list[Column]:
    return [
        F.count_if(actual & flagged).alias("tp"), F.count_if(~actual & flagged).alias("fp"),
        F.count_if(actual & ~flagged).alias("fn"), F.count_if(~actual & ~flagged).alias("tn"),
    ]


def as_flag(prediction: Column) -> Column:
    """The 0 / 1 convention."""
    return prediction.cast("boolean")


def signed_flag(prediction: Column) -> Column:
    """The -1 / +1 convention."""
    return prediction == -1


def classification_metrics(
    df: DataFrame, actual: Column, flagged: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts, precision, recall, F1, macro F1 and shares; undefined ratios are 0."""
    return _with_rates(df.groupBy(*keys).agg(*_confusion(actual, flagged)))


def detection_by_level(df: DataFrame, flagged: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Share of flagged rows per level, for the levels that occur."""
    known = df.filter(F.col("log_level").isin(*LEVELS))
    return known.groupBy(*keys, "log_level").agg(
        F.count("*").alias("n"), F.avg(flagged.cast("int")).alias("detection_rate")
    )


def contamination_sweep(
    train: DataFrame, test: DataFrame, score: str, actual: Column, shares: Sequence[float] = CONTAMINATION_SWEEP
) -> DataFrame:
    """Metrics at several contamination shares. Scores do not depend on the share, so each row is scored once."""
    row = exact_percentiles(train, score, [1 - c for c in shares]).first()
    cuts = F.array(*[
        F.struct(F.lit(c).alias("contamination"), F.lit(row[f"q{i}"]).alias("cut")) for i, c in enumerate(shares)
    ])
    judged = test.select(actual.alias("actual"), F.col(score).alias("score"), F.inline(cuts))
    return _with_rates(
        judged.groupBy("contamination").agg(*_confusion(F.col("actual"), F.col("score") > F.col("cut")))
    )


def best_contamination(sweep: DataFrame) -> float:
    """Highest F1, the smaller share on a tie."""
    return sweep.orderBy(F.desc("f1"), "contamination").first()["contamination"]


def compare_models(metrics: Mapping[str, DataFrame], train_ms: Mapping[str, float] | None = None) -> DataFrame:
    """One row per model with its metrics; ``selected`` marks the highest F1 (first name given on a tie)."""
    out = None
    for position, (name, df) in enumerate(metrics.items()):
        row = df.withColumns(
            {
                "model": F.lit(name), "position": F.lit(position),
                "train_time_ms": F.lit(float((train_ms or {}).get(name, 0.0))),
            }
        )
        out = row if out is None else out.unionByName(row)
    # One row.
    best = out.agg(F.max_by("model", F.struct("f1", -F.col("position"))).alias("best"))
    return out.crossJoin(F.broadcast(best)).withColumn("selected", F.col("model") == F.col("best")).drop("best", "position")


def score_distribution(df: DataFrame, scores: Sequence[str], bins: int = 60) -> DataFrame:
    """Density of the min-max normalised scores of each model in equal bins, as far as they are not empty."""
    long = melt(df, scores, "model", "score")
    # One row per model.
    span = F.broadcast(long.groupBy("model").agg(
        F.min("score").alias("lo"), F.max("score").alias("hi"), F.count("score").alias("total")
    ))
    unit = (F.col("score") - F.col("lo")) / (F.col("hi") - F.col("lo") + F.lit(1e-10))
    placed = long.join(span, "model").withColumn("unit", unit)
    ends = placed.groupBy("model").agg(F.min("unit").alias("a"), F.max("unit").alias("b"))
    # equal scores have the range of a histogram of one value: half a unit to each side
    flat = F.col("a") == F.col("b")
    ends = ends.select(
        "model", F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("a"), F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("b")
    )
    scaled = F.try_divide(F.col("unit") - F.col("a"), F.col("b") - F.col("a")) * bins
    bin_ = F.least(F.floor(scaled), F.lit(bins - 1)).cast("int")
    return placed.join(F.broadcast(ends), "model").withColumn("bin", F.coalesce(bin_, F.lit(0))).groupBy(
        "model", "bin", "total", "a", "b"
    ).agg(F.count("*").alias("n")).select(
        "model", "bin", "n", (F.col("n") * bins / (F.col("total") * (F.col("b") - F.col("a")))).alias("density")
    )


def cold_scores(df: DataFrame) -> DataFrame:
    """Stand-in while no model is available: nothing is anomalous."""
    return df.withColumns({"is_anomaly": F.lit(False), "anomaly_score": F.lit(0.0)})


def score_or_cold(df: DataFrame, model: Forest | None, mode: str | None = None, expected: str = "serving") -> DataFrame:
    """Score with ``model``, or with the stand-in when there is none. A model of another feature form is refused."""
    if model is None:
        return cold_scores(df)
    if mode is not None and mode != expected:
        raise ValueError(f"model was fitted on {mode} features, rows carry {expected} features")
    return model.decide(df)
