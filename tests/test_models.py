"""Models and evaluation."""

import dataclasses

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators.models import evaluation as E
from emberlog.operators.models.ecod import fit_ecod
from emberlog.operators.models.forest import average_path, fit_decision, fit_forest
from emberlog.operators.models.hbos import fit_hbos
from emberlog.operators.models.scaling import fit_scaler, temporal_split
from emberlog.schema import MODEL_FEATURES
from emberlog.sources.artifacts import Bundle, load_bundle, save_bundle

FEATURES = ("a", "b", "c")


def points(n=600, planted=6):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(size=n), "c": rng.integers(0, 3, n).astype(float)})
    pdf.loc[: planted - 1, ["a", "b"]] = 9 + rng.normal(size=(planted, 2))
    pdf["us"], pdf["seq"] = rng.permutation(n) // 3, np.arange(n)
    return pdf


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(points()).repartition(4).cache()


def test_forest_ranks_planted_outliers_first(df):
    forest = fit_decision(fit_forest(df, FEATURES, trees=60), df, 0.05)
    out = forest.decide(df).orderBy(F.desc("anomaly_score")).toPandas()
    assert set(out.seq[:6]) == set(range(6))
    assert abs(out.is_anomaly.mean() - 0.05) < 0.01
    assert (out.is_anomaly == (out.anomaly_score > 0)).all()


def test_forest_depends_on_the_seed_only(df):
    one = fit_forest(df, FEATURES, trees=8, sample_size=64)
    again = fit_forest(df.repartition(7), FEATURES, trees=8, sample_size=64)
    other = fit_forest(df, FEATURES, trees=8, sample_size=64, seed=1)
    pd.testing.assert_frame_equal(one.nodes, again.nodes)
    assert not one.nodes.equals(other.nodes)


def test_trees_are_well_formed(df):
    forest = fit_forest(df, FEATURES, trees=5, sample_size=64)
    for _, tree in forest.nodes.groupby("tree"):
        leaves = tree[tree.feature < 0]
        assert leaves["size"].sum() == 64 and tree.depth.max() <= 6
        for node in tree[tree.feature >= 0].itertuples():
            children = tree.set_index("node")["size"].loc[[node.left, node.right]]
            assert children.sum() == node.size and (children > 0).all()


def test_average_path_length():
    assert average_path(1) == 0 and average_path(2) == 1
    assert float(average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_ecod_is_finite_and_matches_brute_force(df):
    model = fit_ecod(df, FEATURES)
    pdf = points()
    fresh = df.sparkSession.createDataFrame(pd.concat([pdf[:50], pdf[:5].assign(a=99.0, seq=[900, 901, 902, 903, 904])]))
    for rows, seen in ((df, True), (fresh, False), (fresh, True)):
        a = model.score(rows, seen=seen).toPandas().set_index("seq").raw_score.sort_index()
        assert np.isfinite(a).all()
    blank = model.score(fresh.withColumn("a", F.lit(None).cast("double"))).toPandas()
    assert np.isfinite(blank.raw_score).all()
    a = model.score(df, seen=True).toPandas().set_index("seq").raw_score.sort_index()
    want = np.zeros(len(pdf))
    for f in FEATURES:
        x = pdf[f].to_numpy()
        left = -np.log([(x <= v).mean() for v in x])
        right = -np.log([(x >= v).mean() for v in x])
        want += np.maximum(left, right)
    got = model.score(df, seen=True).toPandas().set_index("seq").raw_score.sort_index()
    assert np.allclose(got, want)


def test_symmetric_feature_adds_both_tails(spark):
    flat = spark.createDataFrame([(5.0,)] * 4 + [(5.0,)], "a double")
    assert fit_ecod(flat, ("a",)).skew == {"a": 0}


def test_hbos_matches_numpy_histograms(df):
    model, pdf = fit_hbos(df, FEATURES), points()
    got = model.score(df).toPandas().set_index("seq").raw_score.sort_index()
    want = np.zeros(len(pdf))
    for f in FEATURES:
        density, edges = np.histogram(pdf[f], 10, density=True)
        place = np.clip(np.searchsorted(edges, pdf[f], side="right") - 1, 0, 9)
        want -= np.log2(density[place] + 0.1)
    assert np.allclose(got, want)


def test_hbos_outside_the_range(spark):
    train = spark.createDataFrame([(float(i),) for i in [0, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 10, 10, 10]], "a double")
    model = fit_hbos(train, ("a",))
    scores = {r.a: r.raw_score for r in model.score(
        spark.createDataFrame([(0.0,), (-0.5,), (-0.6,), (10.0,), (10.5,), (10.6,)], "a double")).collect()}
    worst = -min(np.log2(d + 0.1) for d in model.density["a"])
    assert scores[-0.5] == scores[0.0] and scores[10.5] == scores[10.0]
    assert scores[-0.6] == scores[10.6] == pytest.approx(worst)


def test_hbos_constant_feature(spark):
    model = fit_hbos(spark.createDataFrame([(3.0,)] * 5, "a double"), ("a",))
    assert model.low["a"] == 2.5 and model.high["a"] == 3.5


# Published confusion counts and the ratios they give.
@pytest.mark.parametrize("tp,fp,fn,tn,f1,precision,recall,macro,flagged", [
    (284, 171, 190, 2955, 0.6114101184, 0.6241758242, 0.5991561181, 0.7769217710, 0.1263888889),
    (66, 34, 408, 3092, 0.2299651568, 0.66, 0.1392405063, 0.5816291223, 0.0277777778),
    (260, 581, 214, 2545, 0.3954372624, 0.3091557669, 0.5485232068, 0.6301740263, 0.2336111111),
])
def test_metrics_reproduce_published_ratios(spark, tp, fp, fn, tn, f1, precision, recall, macro, flagged):
    counts = [(True, True, tp), (False, True, fp), (True, False, fn), (False, False, tn)]
    df = spark.createDataFrame(counts, "actual boolean, flag boolean, n int").select("actual", "flag", F.explode(
        F.sequence(F.lit(1), "n")).alias("x"))
    m = E.classification_metrics(df, F.col("actual"), F.col("flag")).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (tp, fp, fn, tn)
    assert np.allclose([m.f1, m.precision, m.recall, m.f1_macro, m.flagged_pct], [f1, precision, recall, macro, flagged])


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(False, False)] * 3, "actual boolean, flag boolean")
    m = E.classification_metrics(df, F.col("actual"), F.col("flag")).first()
    assert (m.precision, m.recall, m.f1, m.fp_rate) == (0.0, 0.0, 0.0, 0.0)


def test_prediction_conventions(spark):
    df = spark.createDataFrame([(-1,), (1,)], "p int")
    assert [r.f for r in df.select(E.signed_flag(F.col("p")).alias("f")).collect()] == [True, False]


def test_sweep_prefers_the_smaller_share_on_a_tie(spark):
    df = spark.createDataFrame([(float(i), False) for i in range(50)], "s double, actual boolean")
    sweep = E.contamination_sweep(df, df, "s", F.col("actual"))
    assert sweep.count() == 5 and E.best_contamination(sweep) == 0.02


def test_split_is_temporal(spark):
    df = spark.createDataFrame([(i // 4, i) for i in range(101)], "us long, seq long")
    out = temporal_split(df, rows_per_bucket=13).toPandas()
    assert sorted(out.seq[out.split == "train"]) == list(range(80))


def test_scaler_leaves_constant_features_finite(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = fit_scaler(df, ("a", "b"))
    assert [tuple(r) for r in scaler.transform(df).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_bundle_round_trip_and_order_check(spark, df, tmp_path):
    forest = fit_decision(fit_forest(df, FEATURES, trees=4, sample_size=32), df)
    bundle = Bundle(fit_scaler(df, FEATURES), "batch", "forest", forest, fit_hbos(df, FEATURES), fit_ecod(df, FEATURES))
    save_bundle(spark, bundle, str(tmp_path))
    loaded = load_bundle(spark, str(tmp_path), FEATURES)
    assert loaded.scaler == bundle.scaler and loaded.mode == "batch"
    for a, b in ((bundle.forest, loaded.forest), (bundle.hbos, loaded.hbos), (bundle.ecod, loaded.ecod)):
        x = a.decide(df).toPandas().set_index("seq").anomaly_score.sort_index()
        y = b.decide(df).toPandas().set_index("seq").anomaly_score.sort_index()
        assert np.allclose(x, y)
    with pytest.raises(ValueError):
        load_bundle(spark, str(tmp_path), MODEL_FEATURES)


def test_model_of_another_feature_form_is_refused(df):
    forest = fit_decision(fit_forest(df, FEATURES, trees=2, sample_size=16), df)
    with pytest.raises(ValueError):
        E.score_or_cold(df, forest, "batch")
    assert E.score_or_cold(df, None).filter("is_anomaly").count() == 0


def test_tail_scores_agree_with_and_without_the_merge(spark):
    """Fitted rows are rated by a join, any rows by a merge that carries their numbers; a value most rows share is no special case."""
    from emberlog.operators.models.ecod import fit_ecod

    rows = [(float(i % 3 == 0), float((i * 37) % 101), None if i % 10 == 0 else i / 7, -0.0 if i % 2 else 0.0) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    model = fit_ecod(df, ["a", "b", "c", "d"])
    key = lambda d: sorted((tuple(map(repr, r[:3])), r["raw_score"]) for r in d.collect())
    one, two = key(model.score(df, seen=True)), key(model.score_fitted(df))
    assert [k for k, _ in one] == [k for k, _ in two] and [v for _, v in one] == pytest.approx([v for _, v in two], rel=1e-12)
    assert model.score(df.limit(0)).count() == 0


def test_features_of_few_values_are_looked_up_in_place(spark, monkeypatch):
    """They are neither stored, nor numbered, nor merged, and are rated as by the merge: also unseen values, nulls, NaN and ties."""
    import emberlog.operators.models.ecod as M

    rows = [(float(i % 4), None if i % 9 == 0 else float(i % 50), float("nan") if i == 7 else i / 3, -0.0 if i % 2 else 0.0) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    fresh = spark.createDataFrame([(-1.0, 99.0, 0.1, 0.0), (1.5, None, float("nan"), -0.0), (9.0, 3.0, 1e9, 0.5)], df.schema)
    names = ["a", "b", "c", "d"]
    key = lambda d: sorted((tuple(map(repr, r[:4])), r["raw_score"]) for r in d.collect())
    monkeypatch.setattr(M, "FEW_VALUES", 0)
    model = M.fit_ecod(df, names)
    merged = [key(model.score(df, seen=True)), key(model.score(fresh)), key(model.score(fresh, seen=True)), key(model.score_fitted(df))]
    monkeypatch.setattr(M, "FEW_VALUES", 60)  # c stays with the merge
    mixed = [key(model.score(df, seen=True)), key(model.score(fresh)), key(model.score(fresh, seen=True)), key(model.score_fitted(df))]
    monkeypatch.setattr(M, "FEW_VALUES", 50_000)
    again = M.fit_ecod(df, names)
    for step in ("stage", "running_totals"):
        monkeypatch.setattr(M, step, None)
    short = [key(model.score(df, seen=True)), key(model.score(fresh)), key(model.score(fresh, seen=True)), key(model.score_fitted(df))]
    assert merged == mixed == short and again.offset == model.offset


def test_training_scores_the_clean_rows_once(spark, df, monkeypatch):
    """The offset comes from the stored scores of the training rows, as it does from scoring them again."""
    forest = fit_forest(df, FEATURES, trees=3, sample_size=32)
    want = fit_decision(forest, df)
    stored = forest.score(df).select("raw_score").cache()
    stored.count()
    monkeypatch.setattr(type(forest), "score", None)
    assert fit_decision(forest, df, scores=stored).offset == want.offset
