"""Fitted models, scaler and training data as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.models.ecod import TailModel
from emberlog.operators.models.forest import NODE_SCHEMA, Forest
from emberlog.operators.models.hbos import Histograms
from emberlog.operators.models.scaling import Scaler
from emberlog.schema import MODEL_FEATURES

LABEL_COLUMNS = (
    "timestamp", "log_level", "service_name", "status_code", "response_time_ms", "ip_address", "is_error", "log_level_int",
)
_SCALER = "position int, feature string, mean double, std double"
_SETTINGS = "name string, key string, number double, text string"
_BINS = "feature string, bin int, low double, high double, density double"


@dataclass(frozen=True)
class Bundle:
    """Everything scoring needs. ``mode`` names the feature form the models were fitted on."""

    scaler: Scaler
    mode: str
    best: str
    forest: Forest | None = None
    hbos: Histograms | None = None
    ecod: TailModel | None = None
    #: Latency statistics for serving, and the contamination that the forest's threshold was fitted with.
    stats: Mapping[str, float] | None = None
    contamination: float | None = None

    @property
    def best_model(self):
        return {"forest": self.forest, "hbos": self.hbos, "ecod": self.ecod}[self.best]


def export_splits(df: DataFrame, path: str, format: str = "csv", features: Sequence[str] = MODEL_FEATURES) -> None:
    """Write scaled features and label columns of each split. ``df`` carries ``split``."""
    labels = [c for c in LABEL_COLUMNS if c in df.columns]
    for part in ("train", "test"):
        rows = df.filter(F.col("split") == part)
        for name, columns in (("features", list(features)), ("labels", labels)):
            writer = rows.select(*columns).write.mode("overwrite")
            (writer.option("header", True) if format == "csv" else writer).format(format).save(f"{path}/{part}_{name}")


def save_bundle(spark: SparkSession, bundle: Bundle, path: str, metrics: DataFrame | None = None,
                stats: DataFrame | None = None) -> None:
    """Write one table per part; existing ones are replaced."""

    def put(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{path}/{name}")

    scaler = bundle.scaler
    rows = [(i, f, scaler.mean[f], scaler.std[f]) for i, f in enumerate(scaler.features)]
    put(spark.createDataFrame(rows, _SCALER), "scaler")
    settings: list[tuple] = [("bundle", "mode", None, bundle.mode), ("bundle", "best", None, bundle.best)]
    settings += [("serving", k, float(v), None) for k, v in (bundle.stats or {}).items()]
    if bundle.contamination is not None:
        settings.append(("forest", "contamination", float(bundle.contamination), None))
    if bundle.forest is not None:
        put(spark.createDataFrame(bundle.forest.nodes, NODE_SCHEMA), "forest")
        settings += [("forest", "sample_size", float(bundle.forest.sample_size), None),
                     ("forest", "offset", bundle.forest.offset, None)]
    if bundle.hbos is not None:
        m = bundle.hbos
        bins = [(f, i, m.low[f], m.high[f], d) for f in m.features for i, d in enumerate(m.density[f])]
        put(spark.createDataFrame(bins, _BINS), "hbos")
        settings += [("hbos", k, float(getattr(m, k)), None) for k in ("bins", "alpha", "tolerance", "offset")]
    if bundle.ecod is not None:
        put(bundle.ecod.table, "ecod")
        settings += [("ecod", "total", float(bundle.ecod.total), None), ("ecod", "offset", bundle.ecod.offset, None)]
        settings += [("ecod_skew", f, float(s), None) for f, s in bundle.ecod.skew.items()]
    put(spark.createDataFrame(settings, _SETTINGS), "settings")
    if metrics is not None:
        put(metrics, "metrics")
    if stats is not None:
        put(stats, "feature_stats")


def load_bundle(spark: SparkSession, path: str, features: Sequence[str] = MODEL_FEATURES) -> Bundle:
    """Read a bundle; fails when its feature order is not the expected one."""
    settings = {(r["name"], r["key"]): (r["text"] if r["number"] is None else r["number"])
                for r in spark.read.parquet(f"{path}/settings").collect()}
    rows = spark.read.parquet(f"{path}/scaler").orderBy("position").collect()
    names = tuple(r["feature"] for r in rows)
    if names != tuple(features):
        raise ValueError(f"feature order {names} differs from {tuple(features)}")
    scaler = Scaler(names, {r["feature"]: r["mean"] for r in rows}, {r["feature"]: r["std"] for r in rows})
    forest = hbos = ecod = None
    if ("forest", "offset") in settings:
        nodes = spark.read.parquet(f"{path}/forest").toPandas()  # bounded by trees x sample size
        nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        forest = Forest(names, nodes, int(settings[("forest", "sample_size")]), settings[("forest", "offset")])
    if ("hbos", "offset") in settings:
        bins = spark.read.parquet(f"{path}/hbos").orderBy("feature", "bin").collect()
        density: dict[str, tuple] = {f: () for f in names}
        for r in bins:
            density[r["feature"]] += (r["density"],)
        hbos = Histograms(
            names, int(settings[("hbos", "bins")]), settings[("hbos", "alpha")], settings[("hbos", "tolerance")],
            {r["feature"]: r["low"] for r in bins}, {r["feature"]: r["high"] for r in bins}, density,
            settings[("hbos", "offset")],
        )
    if ("ecod", "offset") in settings:
        skew = {f: int(settings[("ecod_skew", f)]) for f in names}
        ecod = TailModel(names, spark.read.parquet(f"{path}/ecod"), int(settings[("ecod", "total")]), skew,
                         settings[("ecod", "offset")])
    stats = {key: number for (name, key), number in settings.items() if name == "serving"} or None
    return Bundle(scaler, settings[("bundle", "mode")], settings[("bundle", "best")], forest, hbos, ecod, stats, settings.get(("forest", "contamination")))
