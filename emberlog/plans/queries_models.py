"""Registered queries on model features, fitted models and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.operators import aggregates as G
from emberlog.operators import features as Fe
from emberlog.operators.models import evaluation as E
from emberlog.operators.models.ecod import fit_ecod
from emberlog.operators.models.forest import contamination_offset, fit_decision, fit_forest
from emberlog.operators.models.hbos import fit_hbos
from emberlog.operators.models.scaling import fit_scaler, temporal_split
from emberlog.plans.catalog import query
from emberlog.plans.queries import CYCLE, FEATURE_CTE, incidents_until, logs, narrow
from emberlog.plans.training import actual, prepare, train
from emberlog.schema import MODEL_FEATURES
from emberlog.session import fresh_path, stage
from emberlog.sources.artifacts import Bundle, export_splits, load_bundle, save_bundle

SPLIT_CTE = (
    "ranked AS (SELECT *, row_number() OVER (ORDER BY us, seq) AS rank FROM logs), "
    "parts AS (SELECT *, CASE WHEN rank <= floor((SELECT count(*) FROM logs) * 0.8) THEN 'train' ELSE 'test' END AS split, "
    "(log_level IN ('ERROR','CRITICAL') OR status_code >= 400) AS actual FROM ranked)"
)
OUTSIDE = (
    f"NOT ({CYCLE} >= 300 AND {CYCLE} < 480 OR {CYCLE} >= 720 AND {CYCLE} < 840 OR {CYCLE} >= 1200 AND {CYCLE} < 1320)"
)
METRIC_COLUMNS = (
    "tp:i fp:i fn:i tn:i precision:d recall:d f1:d f1_macro:d flagged_pct:d fp_rate:d"
)


def metric_sql(source: str, keys: str = "") -> str:
    """Confusion counts and rates of ``actual`` against ``flagged``."""
    by = f" GROUP BY {keys}" if keys else ""
    more = f"{keys}, " if keys else ""
    return (
        f"SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, "
        "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, (coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) + "
        "coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / 2 AS f1_macro, (tp + fp) / (tp + fp + fn + tn) AS flagged_pct, "
        f"coalesce(fp / nullif(fp + tn, 0), 0) AS fp_rate FROM (SELECT {more}count(*) FILTER (actual AND flagged) AS tp, "
        "count(*) FILTER (NOT actual AND flagged) AS fp, count(*) FILTER (actual AND NOT flagged) AS fn, "
        f"count(*) FILTER (NOT actual AND NOT flagged) AS tn FROM ({source}){by})"
    )


def split_logs(spark, sf_dir):
    return temporal_split(logs(spark, sf_dir).select(*Fe_INPUT))


Fe_INPUT = ("us", "seq", "log_level", "status_code", "anomaly_score", "response_time_ms", "is_anomaly")


@query(
    "A15_feature_stats",
    "feature:s mean:d std:d min:d p25:d median:d p75:d p95:d p99:d max:d null_pct:d scaler_mean:d scaler_std:d",
    FEATURE_CTE + " => " + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(avg({f}), 4) AS mean, round(stddev_samp({f}), 4) AS std, round(min({f}), 4) AS min, "
        + ", ".join(f"round(quantile_cont({f}, {p}), 4) AS {n}" for n, p in
                    (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95), ("p99", 0.99)))
        + f", round(max({f}), 4) AS max, 0.0 AS null_pct, round(avg({f}), 6) AS scaler_mean, "
        f"round(stddev_pop({f}), 6) AS scaler_std FROM feat"
        for f in MODEL_FEATURES
    ),
)
def _(spark, sf_dir):
    features = stage(Fe.batch_features(narrow(spark, sf_dir)), "features")
    return G.feature_stats(features)


@query(
    "K01_scaler", "feature:s mean:d std:d",
    FEATURE_CTE + " => " + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, avg({f}) AS mean, stddev_pop({f}) AS std FROM feat" for f in MODEL_FEATURES
    ),
)
def _(spark, sf_dir):
    scaler = fit_scaler(Fe.batch_features(narrow(spark, sf_dir)))
    rows = [(f, scaler.mean[f] + 0.0, scaler.std[f]) for f in scaler.features]
    out = spark.createDataFrame(rows, "feature string, mean double, std double")
    return out.withColumn("mean", F.round("mean", 6) + F.lit(0.0))


@query(
    "K01_scaled_features", "seq:i " + " ".join(f"{f}:d" for f in MODEL_FEATURES),
    FEATURE_CTE + " => SELECT seq, "
    + ", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS {f}" for f in MODEL_FEATURES) + " FROM feat",
)
def _(spark, sf_dir):
    return prepare(narrow(spark, sf_dir)).scaled


@query(
    "K09_temporal_split", "split:s n:i first_us:i last_us:i",
    SPLIT_CTE + " => SELECT split, count(*) AS n, min(us) AS first_us, max(us) AS last_us FROM parts GROUP BY 1",
)
def _(spark, sf_dir):
    return split_logs(spark, sf_dir).groupBy("split").agg(
        F.count("*").alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us")
    )


@query("K07_labels", "seq:i actual:b", SPLIT_CTE + " => SELECT seq, actual FROM parts")
def _(spark, sf_dir):
    return logs(spark, sf_dir).withColumn("actual", actual())


@query("K08_clean_training", "seq:i us:i", SPLIT_CTE + f" => SELECT seq, us FROM parts WHERE split = 'train' AND {OUTSIDE}")
def _(spark, sf_dir):
    df = split_logs(spark, sf_dir)
    return E.clean_training(df.filter("split = 'train'"), incidents_until(df, E.TRAINING_EXCLUSIONS))


@query(
    "K06_contamination_threshold", "threshold:d",
    SPLIT_CTE + f" => SELECT quantile_cont(anomaly_score, 0.95) AS threshold FROM parts WHERE split = 'train' AND {OUTSIDE}",
)
def _(spark, sf_dir):
    df = split_logs(spark, sf_dir)
    clean = E.clean_training(df.filter("split = 'train'"), incidents_until(df, E.TRAINING_EXCLUSIONS))
    return spark.createDataFrame([(contamination_offset(clean, "anomaly_score"),)], "threshold double")


@query(
    "K10_metrics", METRIC_COLUMNS,
    SPLIT_CTE + " => " + metric_sql("SELECT actual, response_time_ms > 500 AS flagged FROM parts WHERE split = 'test'"),
)
def _(spark, sf_dir):
    test = split_logs(spark, sf_dir).filter("split = 'test'")
    return E.classification_metrics(test, actual(), F.col("response_time_ms") > 500)


@query(
    "K10_label_metrics", METRIC_COLUMNS,
    metric_sql("SELECT quality = 0 AS actual, toxic = 1 AS flagged FROM labels"),
)
def _(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return E.classification_metrics(labels, F.col("quality") == 0, F.col("toxic") == 1)


@query(
    "K11_detection_by_level", "log_level:s n:i detection_rate:d",
    SPLIT_CTE + " => SELECT log_level, count(*) AS n, avg(CASE WHEN response_time_ms > 500 THEN 1.0 ELSE 0.0 END) AS "
    "detection_rate FROM parts WHERE split = 'test' GROUP BY 1",
)
def _(spark, sf_dir):
    test = split_logs(spark, sf_dir).filter("split = 'test'")
    return E.detection_by_level(test, F.col("response_time_ms") > 500)


_CUTS = ", ".join(
    f"(SELECT {c}::DOUBLE AS contamination, quantile_cont(anomaly_score, {q}) AS cut FROM parts WHERE split = 'train')"
    for c, q in ((0.02, 0.98), (0.05, 0.95), (0.08, 0.92), (0.1, 0.9), (0.15, 0.85))
).replace("), (", ") UNION ALL (")


@query(
    "K12_contamination_sweep", f"contamination:d {METRIC_COLUMNS}",
    SPLIT_CTE + f", cuts AS ({_CUTS}) => " + metric_sql(
        "SELECT contamination, actual, anomaly_score > cut AS flagged FROM parts, cuts WHERE split = 'test'", "contamination"
    ),
)
def _(spark, sf_dir):
    df = stage(split_logs(spark, sf_dir), "split")
    return E.contamination_sweep(df.filter("split = 'train'"), df.filter("split = 'test'"), "anomaly_score", actual())


@query(
    "K13_model_comparison", f"model:s selected:b {METRIC_COLUMNS}",
    SPLIT_CTE + ", both_ AS (" + metric_sql(
        "SELECT model, actual, response_time_ms > cut AS flagged FROM parts, (SELECT 'strict' AS model, 2000 AS cut UNION ALL "
        "SELECT 'loose', 200) WHERE split = 'test'", "model"
    ) + ") => SELECT *, model = (SELECT model FROM both_ ORDER BY f1 DESC, model DESC LIMIT 1) AS selected FROM both_",
)
def _(spark, sf_dir):
    test = split_logs(spark, sf_dir).filter("split = 'test'")
    cuts = {"strict": 2000, "loose": 200}
    return E.compare_models(
        {m: E.classification_metrics(test, actual(), F.col("response_time_ms") > cut) for m, cut in cuts.items()}
    )


@query(
    "K14_score_distribution", "model:s bin:i n:i",
    "s AS (SELECT 'latency' AS model, CAST(response_time_ms AS DOUBLE) AS score FROM logs UNION ALL "
    "SELECT 'severity', level_int FROM logs), "
    "r AS (SELECT model, (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w + 1e-10) AS unit FROM s "
    "WINDOW w AS (PARTITION BY model)), z AS (SELECT model, (unit - min(unit) OVER w) / (max(unit) OVER w - min(unit) OVER w) "
    "* 60 AS x FROM r WINDOW w AS (PARTITION BY model)) => "
    "SELECT model, least(floor(x), 59) AS bin, count(*) AS n FROM z GROUP BY 1, 2",
)
def _(spark, sf_dir):
    df = logs(spark, sf_dir).select(F.col("response_time_ms").alias("latency"), F.col("level_int").alias("severity"))
    return E.score_distribution(df, ("latency", "severity"))


@query("K14_constant", "model:s bin:i n:i density:d", "SELECT 'same' AS model, 30 AS bin, count(*) AS n, 60.0 AS density FROM logs")
def _(spark, sf_dir):
    """Equal scores fill the middle bin of a range one unit wide."""
    return E.score_distribution(logs(spark, sf_dir).select(F.lit(2.5).alias("same")), ("same",))


@query(
    "K15_cold_scores", "seq:i is_anomaly:b anomaly_score:d",
    "SELECT seq, FALSE AS is_anomaly, 0.0 AS anomaly_score FROM logs",
)
def _(spark, sf_dir):
    return E.score_or_cold(logs(spark, sf_dir), None)


HBOS_FEATURES = MODEL_FEATURES


def _hbos_feature_sql(f: str) -> str:
    bin_ = f"CASE WHEN {f} = hi THEN 9 ELSE CAST(floor(({f} - lo) * 10 / (hi - lo)) AS INT) END"
    return (
        f"r_{f} AS (SELECT CASE WHEN min({f}) = max({f}) THEN min({f}) - 0.5 ELSE min({f}) END AS lo, "
        f"CASE WHEN min({f}) = max({f}) THEN max({f}) + 0.5 ELSE max({f}) END AS hi FROM feat), "
        f"b_{f} AS (SELECT seq, {bin_} AS bin, hi - lo AS width FROM feat, r_{f}), "
        f"h_{f} AS (SELECT bin, -log2(count(*) * 10 / ((SELECT count(*) FROM feat) * any_value(width)) + 0.1) AS s "
        f"FROM b_{f} GROUP BY 1)"
    )


@query(
    "K05_hbos_scores", "seq:i raw_score:d",
    FEATURE_CTE + ", " + ", ".join(_hbos_feature_sql(f) for f in HBOS_FEATURES) + " => SELECT f.seq, "
    + " + ".join(f"h_{f}.s" for f in HBOS_FEATURES) + " AS raw_score FROM feat f "
    + " ".join(f"JOIN b_{f} ON b_{f}.seq = f.seq JOIN h_{f} ON h_{f}.bin = b_{f}.bin" for f in HBOS_FEATURES),
)
def _(spark, sf_dir):
    features = stage(Fe.batch_features(narrow(spark, sf_dir)), "features")
    return fit_hbos(features, HBOS_FEATURES).score(features)


def _tail_sql(f: str) -> str:
    left = f"-ln(cume_dist() OVER (ORDER BY {f}))"
    right = f"-ln(cume_dist() OVER (ORDER BY {f} DESC))"
    return f"CASE WHEN (SELECT skewness({f}) FROM feat) = 0 THEN {left} + {right} ELSE greatest({left}, {right}) END"


@query(
    "K04_ecod_scores", "seq:i raw_score:d",
    FEATURE_CTE + " => SELECT seq, " + " + ".join(_tail_sql(f) for f in HBOS_FEATURES) + " AS raw_score FROM feat",
)
def _(spark, sf_dir):
    features = stage(Fe.batch_features(narrow(spark, sf_dir)), "features")
    return fit_ecod(features, HBOS_FEATURES).score(features, seen=True)


def _fitted(spark, sf_dir):
    data = prepare(narrow(spark, sf_dir))
    clean = stage(
        E.clean_training(data.train, incidents_until(data.scaled, E.TRAINING_EXCLUSIONS)).select("us", "seq", *MODEL_FEATURES),
        "clean",
    )
    return data, clean, fit_forest(clean)


@query("K02_forest_nodes", "tree:i node:i feature:i threshold:d left:i right:i size:i depth:i")
def _(spark, sf_dir):
    _, _, forest = _fitted(spark, sf_dir)
    return spark.createDataFrame(forest.nodes)


@query("K03_forest_scores", "seq:i anomaly_score:d is_anomaly:b")
def _(spark, sf_dir):
    data, clean, forest = _fitted(spark, sf_dir)
    return fit_decision(forest, clean).decide(data.scaled)


@query("K13_training_run", f"model:s selected:b {METRIC_COLUMNS}")
def _(spark, sf_dir):
    df = narrow(spark, sf_dir)
    return train(df, incidents_until(df, E.TRAINING_EXCLUSIONS))[1]


@query(
    "S13_split_export", "split:s rows_features:i rows_labels:i",
    SPLIT_CTE + " => SELECT split, count(*) AS rows_features, count(*) AS rows_labels FROM parts GROUP BY 1",
)
def _(spark, sf_dir):
    path = fresh_path(spark, "export")
    export_splits(prepare(narrow(spark, sf_dir)).scaled, path)
    out = None
    for part in ("train", "test"):
        counts = [
            spark.read.option("header", True).csv(f"{path}/{part}_{kind}").agg(F.count("*").alias(f"rows_{kind}"))
            for kind in ("features", "labels")
        ]
        row = counts[0].crossJoin(counts[1]).withColumn("split", F.lit(part))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "F10_serving_statistics", "seq:i response_time_zscore:d mean:d std:d",
    "m AS (SELECT round(avg(response_time_ms), 4) AS mean, round(stddev_samp(response_time_ms), 4) AS std FROM logs) => "
    "SELECT seq, (response_time_ms - mean) / (std + 1e-10) AS response_time_zscore, mean, std FROM logs, m",
)
def _(spark, sf_dir):
    """Serving features with the statistics that the bundle of a fit carries, saved and read back."""
    df = narrow(spark, sf_dir)
    data = prepare(df, mode="serving")
    path = fresh_path(spark, "models")
    save_bundle(spark, Bundle(data.scaler, "serving", "forest", stats=data.stats), path)
    stats = load_bundle(spark, path).stats
    return Fe.serving_features(df, stats=stats).withColumns({"mean": F.lit(stats["mean"]), "std": F.lit(stats["std"])})


@query(
    "S14_model_round_trip", "model:s rows:i differing:i",
    "SELECT unnest(['forest', 'hbos', 'ecod']) AS model, (SELECT count(*) FROM logs) AS rows, 0 AS differing",
)
def _(spark, sf_dir):
    df = narrow(spark, sf_dir)
    bundle, comparison, _ = train(df, incidents_until(df, E.TRAINING_EXCLUSIONS))
    path = fresh_path(spark, "models")
    save_bundle(spark, bundle, path, comparison)
    loaded = load_bundle(spark, path)
    rows = prepare(df).scaled.select("seq", *MODEL_FEATURES)
    out = None
    for name in ("forest", "hbos", "ecod"):
        before = getattr(bundle, name).decide(rows).select("seq", F.col("anomaly_score").alias("before"))
        after = getattr(loaded, name).decide(rows).select("seq", F.col("anomaly_score").alias("after"))
        compared = before.join(after, "seq").agg(
            F.count("*").alias("rows"), F.count_if(F.abs(F.col("before") - F.col("after")) > 1e-9).alias("differing")
        ).withColumn("model", F.lit(name))
        out = compared if out is None else out.unionByName(compared)
    return out
