"""Exact percentiles through sketch brackets, and bottom-k samples."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators import quantiles as Q
from emberlog.operators.aggregates import interpolated_percentile
from emberlog.operators.models.forest import fit_forest

SHARES = [0.0, 0.004, 0.5, 0.95, 0.999, 1.0]


def test_a_million_distinct_values(spark):
    """Equals DuckDB, and only a small part of the rows is ordered."""
    df = spark.range(1_000_000).select((F.rand(3) * F.rand(4) - F.lit(0.2)).alias("v")).repartition(4)
    from emberlog.session import stage

    df = stage(df, "million")
    want = duckdb.sql(f"SELECT quantile_cont(v, {SHARES}) FROM '{df.inputFiles()[0].rsplit('/', 1)[0].removeprefix('file:')}/*.parquet'").fetchall()[0][0]
    got = Q.exact_percentiles(df, "v", SHARES, most=20_000).first()
    assert [got[f"q{i}"] for i in range(len(SHARES))] == pytest.approx(want, abs=1e-15) and got["total"] == 1_000_000
    assert [r for r in Q.exact_percentiles(df, "v", [0.5]).first()][1] == pytest.approx(want[2], abs=1e-15)


@pytest.mark.parametrize("most", [1_000_000, 50, 7])
def test_groups_ties_and_nulls(spark, most):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "hot"], 3000, p=[0.1, 0.1, 0.8]), "v": rng.normal(size=3000).round(2)})
    pdf.loc[pdf.index % 3 == 0, "v"] = 0.25
    rows = [(r.k, float(r.v)) for r in pdf.itertuples()] + [("none", None), ("one", 4.5), (None, 1.0), (None, 2.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: [r[f"q{i}"] for i in range(len(SHARES))] for r in Q.exact_percentiles(df, "v", SHARES, ["k"], most=most).collect()}
    for k in ("a", "b", "hot"):
        assert got[k] == pytest.approx(np.quantile(pdf.v[pdf.k == k], SHARES).tolist(), abs=1e-12)
    assert got["one"] == [4.5] * 6 and got["none"] == [None] * 6 and got[None] == pytest.approx(np.quantile([1, 2], SHARES).tolist())


def test_empty_tables_and_types(spark):
    empty = spark.createDataFrame([], "v double, i int")
    assert Q.exact_percentiles(empty, "v", [0.5]).first()["q0"] is None
    assert interpolated_percentile(empty, "v", 0.5).first().value is None and interpolated_percentile(empty, "i", 0.5).first().value is None


def test_no_full_shuffle(spark):
    """The rows that are counted by value are those inside the bracket."""
    df = spark.range(200_000).select(F.rand(5).alias("v")).cache()
    brackets = Q.stage(df.agg(F.count("v").alias("total")).select(
        "total", *[F.lit(None).cast("double").alias(c) for c in ("lo0", "hi0")], F.lit(0).cast("long").alias("below0"), F.col("total").alias("inside0"), F.floor((F.col("total") - 1) * 0.95).alias("k0")), "b")
    row = Q._narrowed(df, brackets, [], 1).first()
    assert row["inside0"] < 0.02 * 200_000 and row["below0"] <= row["k0"] < row["below0"] + row["inside0"]


def test_bottom_k_samples_hold_different_rows(spark):
    df = spark.createDataFrame([(i, i, float(i), float(i * i % 97)) for i in range(3000)], "us long, seq long, a double, b double")
    forest = fit_forest(df, ["a", "b"], trees=20, sample_size=64, seed=3)
    roots = forest.nodes[forest.nodes.node == 0]
    assert len(roots) == 20 and set(roots["size"]) == {64}
    again = fit_forest(df.repartition(7), ["a", "b"], trees=20, sample_size=64, seed=3)
    pd.testing.assert_frame_equal(forest.nodes, again.nodes)
    other = fit_forest(df, ["a", "b"], trees=20, sample_size=64, seed=4)
    assert not other.nodes.equals(forest.nodes)
    few = fit_forest(df.filter("us < 10"), ["a", "b"], trees=3, sample_size=64)
    assert set(few.nodes[few.nodes.node == 0]["size"]) == {10}
    leaves = forest.nodes[forest.nodes.feature < 0].groupby("tree")["size"].sum()
    assert (leaves == 64).all()
