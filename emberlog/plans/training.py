"""Training from raw logs to a selected model."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.operators.features import batch_features, serving_features, serving_stats
from emberlog.operators.joins import Incident
from emberlog.operators.models import evaluation as E
from emberlog.operators.models.ecod import fit_ecod
from emberlog.operators.models.forest import Forest, fit_decision, fit_forest
from emberlog.operators.models.hbos import fit_hbos
from emberlog.operators.models.scaling import fit_scaler, temporal_split
from emberlog.schema import CONTAMINATION, MODEL_FEATURES
from emberlog.session import stage
from emberlog.sources.artifacts import Bundle

INPUT = (
    "us", "seq", "timestamp", "log_level", "service_name", "status_code", "response_time_ms", "ip_address",
)


@dataclass(frozen=True)
class Prepared:
    """Stored features with the split, which every fit reads, and their scaled form, a few sums on the stored columns."""

    features: DataFrame
    scaled: DataFrame
    scaler: object
    stats: Mapping[str, float]

    @property
    def train(self) -> DataFrame:
        return self.scaled.filter("split = 'train'")

    @property
    def test(self) -> DataFrame:
        return self.scaled.filter("split = 'test'")


def prepare(logs: DataFrame, mode: str = "batch", fit_on: str = "all") -> Prepared:
    """Engineer features in one of their two forms, scale them and split by time."""
    if mode not in ("batch", "serving") or fit_on not in ("all", "train"):
        raise ValueError("mode is batch or serving, fit_on is all or train")
    stats = serving_stats(logs)
    engineered = batch_features(logs) if mode == "batch" else serving_features(logs, stats=stats)
    features = stage(temporal_split(engineered, rows=logs.count()), "features")
    scaler = fit_scaler(features if fit_on == "all" else features.filter("split = 'train'"))
    return Prepared(features, scaler.transform(features), scaler, stats)


def actual() -> F.Column:
    return E.truth(F.col("log_level"), F.col("status_code"))


def train(
    logs: DataFrame, incidents: Sequence[Incident], mode: str = "batch", fit_on: str = "all",
    contamination: float = CONTAMINATION, tune: bool = True, trees: int = 100,
) -> tuple[Bundle, DataFrame, DataFrame]:
    """Fit the three models on clean training rows; returns the bundle, the model comparison and the sweep."""
    data = prepare(logs, mode, fit_on)
    clean = stage(E.clean_training(data.train, incidents).select("us", "seq", *MODEL_FEATURES), "clean")
    spent: dict[str, float] = {}

    def timed(name: str, fit):
        start = time.perf_counter()
        model = fit()
        spent[name] = round((time.perf_counter() - start) * 1000, 1)
        return model

    bare: Forest = timed("forest", lambda: fit_forest(clean, trees=trees))
    train_scores = stage(bare.score(clean.select(*MODEL_FEATURES)).select("raw_score"), "scores")
    test_scores = stage(bare.score(data.test).select("raw_score", "log_level", "status_code"), "scores")
    sweep = stage(E.contamination_sweep(train_scores, test_scores, "raw_score", actual()), "sweep")
    share = E.best_contamination(sweep) if tune else contamination
    forest = fit_decision(bare, clean, share, train_scores)
    hbos = timed("hbos", lambda: fit_hbos(clean, contamination=contamination))
    ecod = timed("ecod", lambda: fit_ecod(clean, contamination=contamination))
    models = {"forest": forest, "ecod": ecod, "hbos": hbos}
    metrics = {
        name: E.classification_metrics(m.decide(data.test), actual(), F.col("is_anomaly")) for name, m in models.items()
    }
    comparison = stage(E.compare_models(metrics, spent), "comparison")
    best = comparison.filter("selected").first()["model"]
    return Bundle(data.scaler, mode, best, forest, hbos, ecod, data.stats, share), comparison, sweep
