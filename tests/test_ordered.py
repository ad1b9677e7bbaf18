"""Ordered operators against brute force, with ties, bursts and hot keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators import ordered as O

def one():
    return F.lit(1).cast("bigint")


def rows(seed: int, n: int = 900) -> pd.DataFrame:
    """A third of all rows at one instant, a third from one key, the rest spread out with ties."""
    rng = np.random.default_rng(seed)
    us = rng.integers(0, 400, n) * 1000
    us[: n // 3] = 123_000
    key = rng.choice(["a", "b", "c", "d"], n)
    key[n // 2 : n // 2 + n // 3] = "hot"
    pdf = pd.DataFrame({"us": us, "seq": rng.permutation(n), "ip": key, "v": rng.integers(0, 50, n)})
    return pdf.sort_values(["us", "seq"]).reset_index(drop=True)


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    pdf = rows(request.param)
    return pdf, spark.createDataFrame(pdf.sample(frac=1, random_state=3)).repartition(5)


def collected(df, column):
    pdf = df.select("seq", column).toPandas()
    return pdf.set_index("seq")[column]


@pytest.mark.parametrize("per_bucket", [5, 60, 10_000])
def test_rank(data, per_bucket):
    pdf, df = data
    got = collected(O.ranked(df, ("us", "seq"), rows_per_bucket=per_bucket), "rank")
    assert (got.loc[pdf.seq].to_numpy() == np.arange(1, len(pdf) + 1)).all()


@pytest.mark.parametrize("per_bucket", [5, 60])
def test_one_instant_does_not_fill_one_bucket(data, per_bucket):
    pdf, df = data
    splits = O.split_order(df, ("us", "seq"), per_bucket)
    sizes = splits.tag(df, "b").groupBy("b").count().toPandas()["count"]
    assert sizes.max() < max(60, 6 * per_bucket) < len(pdf) // 3 * 2
    assert sizes.max() < len(pdf) / 3


def test_tree_and_array_search_agree(data):
    pdf, df = data
    splits = O.split_order(df, ("us", "seq"), 9)
    assert splits.buckets > O.MAX_TREE_BOUNDS
    keys = sorted(splits.bounds)
    want = [sum(b <= (u, s) for b in keys) for u, s in zip(pdf.us, pdf.seq)]
    assert collected(splits.tag(df, "b"), "b").loc[pdf.seq].tolist() == want
    few = O.OrderSplits(splits.columns, splits.bounds[::4], splits.types)
    assert few.buckets <= O.MAX_TREE_BOUNDS
    want = [sum(b <= (u, s) for b in few.bounds) for u, s in zip(pdf.us, pdf.seq)]
    assert collected(few.tag(df, "b"), "b").loc[pdf.seq].tolist() == want


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("keys", [(), ("ip",)])
def test_trailing_window(data, closed, keys):
    pdf, df = data
    width = 20_000
    out = O.trailing_totals(
        df, "us", "seq", width, {"n": one(), "s": F.col("v")}, keys, closed, {"rank": one()}, rows_per_bucket=70
    ).toPandas().set_index("seq").loc[pdf.seq]
    n, s = [], []
    for i, r in pdf.iterrows():
        near = pdf.iloc[: i + 1]
        near = near[(near.us >= r.us - width) if closed else (near.us > r.us - width)]
        if keys:
            near = near[near.ip == r.ip]
        n.append(len(near))
        s.append(near.v.sum())
    assert out.n.tolist() == n and out.s.tolist() == s
    if not keys:
        assert out["rank"].tolist() == list(range(1, len(pdf) + 1))


def test_fractional_sums_are_exact(spark):
    pdf = pd.DataFrame({"us": range(200), "seq": range(200), "v": ["0.1"] * 200})
    df = spark.createDataFrame(pdf).withColumn("v", F.col("v").cast("decimal(28,6)"))
    out = O.trailing_totals(df, "us", "seq", 10, {"s": F.col("v")}, rows_per_bucket=30).toPandas()
    assert sorted({float(x) for x in out.s[out.us >= 9]}) == [1.0]


@pytest.mark.parametrize("per_block", [10, 37, 1000])
def test_trailing_rows(data, per_block):
    pdf, df = data
    numbered = O.ranked(df, ("us", "seq"), rows_per_bucket=100)
    got = collected(O.trailing_rows(numbered, "rank", 10, {"s": F.col("v")}, per_block), "s")
    assert got.loc[pdf.seq].tolist() == pdf.v.rolling(10, min_periods=1).sum().astype(int).tolist()


def test_running_counts_of_a_hot_key(data):
    pdf, df = data
    got = collected(O.running_counts(df, "ip", "us", "seq", "n", rows_per_bucket=50), "n")
    assert (got.loc[pdf.seq].to_numpy() == (pdf.groupby("ip").cumcount() + 1).to_numpy()).all()


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(i, i, None if i % 2 else "x") for i in range(60)], "us long, seq long, ip string")
    out = O.running_counts(df, "ip", "us", "seq", "n", rows_per_bucket=7).toPandas()
    assert len(out) == 60 and sorted(out.n) == sorted(list(range(1, 31)) * 2)


@pytest.mark.parametrize("per_bucket", [7, 10_000])
def test_exact_quantiles(data, per_bucket):
    pdf, df = data
    probabilities = [0, 0.25, 0.5, 0.95, 0.99, 1]
    out = O.exact_quantiles(O.melt(df, ["v", "us"]), probabilities, per_bucket).toPandas().set_index("feature")
    for c in ("v", "us"):
        assert np.allclose(out.loc[c, [f"q{i}" for i in range(6)]].astype(float), np.quantile(pdf[c], probabilities))


def test_distribution_counts_both_tails(data):
    pdf, df = data
    out = O.distribution(O.melt(df, ["v"]), 5).toPandas()
    for r in out.itertuples():
        assert r.at_most == (pdf.v <= r.value).sum() and r.at_least == (pdf.v >= r.value).sum() and r.total == len(pdf)


def test_empty_input(spark):
    df = spark.createDataFrame([], "us long, seq long, v long, ip string")
    assert O.ranked(df, ("us", "seq")).count() == 0
    assert O.trailing_totals(df, "us", "seq", 5, {"s": F.col("v")}).count() == 0
    assert O.column_quantiles(df, "v", [0.5]) == [None]


@pytest.fixture
def few_on_the_driver(monkeypatch):
    """Cut points of more than 16 buckets are stored; counts the keys that come to the driver."""
    seen, sample = [], O._sample_keys
    monkeypatch.setattr(O, "MAX_DRIVER_BUCKETS", 16)
    monkeypatch.setattr(O, "_sample_keys", lambda *a: (seen.append(sample(*a)), seen[-1])[1])
    monkeypatch.setattr(O, "MIN_ROWS_TO_SPLIT", 200)
    return seen


@pytest.mark.parametrize("per_bucket", [3, 7, 40])
def test_stored_cut_points(data, few_on_the_driver, per_bucket):
    """Buckets in proportion to the rows: the order holds, the driver's sample does not grow, and no row carries the cut points."""
    pdf, df = data
    splits = O.split_order(df, ("us", "seq"), per_bucket)
    tagged = splits.tag(df, "b")
    text = tagged._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert len(few_on_the_driver) == 1 and len(few_on_the_driver[0]) <= 6 * O.SAMPLES_PER_BUCKET
    assert len(splits.bounds) < 16 < splits.buckets
    buckets = collected(tagged, "b").loc[pdf.seq].to_numpy()
    assert (np.diff(buckets) >= 0).all() and 0 <= buckets[0] and buckets[-1] < splits.buckets
    assert np.bincount(buckets).max() <= 4 * per_bucket + 8
    got = collected(O.ranked(df, ("us", "seq"), rows_per_bucket=per_bucket), "rank")
    assert (got.loc[pdf.seq].to_numpy() == np.arange(1, len(pdf) + 1)).all()
    got = collected(O.running_counts(df, "ip", "us", "seq", "n", rows_per_bucket=per_bucket), "n")
    assert (got.loc[pdf.seq].to_numpy() == (pdf.groupby("ip").cumcount() + 1).to_numpy()).all()


def test_stored_cut_points_of_a_trailing_window(data, few_on_the_driver):
    pdf, df = data
    values = {"n": one(), "s": F.col("v")}
    got, want = (
        O.trailing_totals(df, "us", "seq", 20_000, values, overall={"rank": one()}, rows_per_bucket=size).toPandas().set_index("seq").loc[pdf.seq]
        for size in (7, 10_000)
    )
    assert got[["n", "s", "rank"]].equals(want[["n", "s", "rank"]])
    assert all(len(s) <= 10 * O.SAMPLES_PER_BUCKET for s in few_on_the_driver)


def windows_in_one_task(df) -> list[str]:
    """Window nodes of the plan fed by a single-partition exchange."""
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    return [line for line in lines if "Window" in line and "windowspecdefinition(" in line]


def test_rows_are_never_ordered_in_one_task(data):
    _, df = data
    plan = O.running_totals(df, ("us", "seq"), {"n": one()}, rows_per_bucket=50)
    for spec in windows_in_one_task(plan):
        # The only window without a partition key runs over the per-bucket totals.
        assert "__bucket" in spec
    keyed = O.running_totals(df, ("us", "seq"), {"n": one()}, ("ip",), rows_per_bucket=50)
    text = keyed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
