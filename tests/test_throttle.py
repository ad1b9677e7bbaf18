"""The throttle against an ordered scan per key."""

import numpy as np
import pandas as pd
import pytest

from emberlog.operators.throttle import throttle


def scan(pdf, period, last=None):
    last, passed = dict(last or {}), []
    for r in pdf.sort_values(["us", "seq"]).itertuples():
        if r.key not in last or r.us - last[r.key] >= period:
            last[r.key] = r.us
            passed.append(r.seq)
    return passed, last


def rows(seed, n=800, span=2000, hot=True):
    rng = np.random.default_rng(seed)
    key = rng.choice(list("abcdef"), n)
    if hot:
        key[: n // 2] = "hot"
    us = rng.integers(0, span, n)
    us[n // 4 : n // 2] = rng.integers(700, 710, n // 2 - n // 4)
    return pd.DataFrame({"us": us, "seq": rng.permutation(n), "key": key})


@pytest.mark.parametrize("seed,per_bucket,period", [(1, 20, 30), (2, 50, 7), (3, 13, 400), (4, 10_000, 30), (5, 9, 5000)])
def test_equals_ordered_scan(spark, seed, per_bucket, period):
    pdf = rows(seed)
    got = throttle(spark.createDataFrame(pdf), ["key"], "us", "seq", period, rows_per_bucket=per_bucket)
    assert sorted(r.seq for r in got.collect()) == sorted(scan(pdf, period)[0])


def test_carries_on_from_earlier_passes(spark):
    pdf = rows(7)
    early, late = pdf[pdf.us < 900], pdf[pdf.us >= 900]
    first, last = scan(early, 60)
    carried = spark.createDataFrame(list(last.items()), "key string, last_us long")
    got = throttle(spark.createDataFrame(late), ["key"], "us", "seq", 60, carried, rows_per_bucket=25)
    assert sorted(first + [r.seq for r in got.collect()]) == sorted(scan(pdf, 60)[0])


def test_one_row_per_instant_and_key(spark):
    df = spark.createDataFrame([(5, 2, "a"), (5, 1, "a"), (5, 3, "b")], "us long, seq long, key string")
    assert sorted(r.seq for r in throttle(df, ["key"], "us", "seq", 10).collect()) == [1, 3]


def test_period_must_be_positive(spark):
    with pytest.raises(ValueError):
        throttle(spark.range(1), ["id"], "id", "id", 0)


def test_null_keys_are_keys(spark):
    rows = [(None if i % 3 == 0 else "a", i * 1000, i) for i in range(60)]
    df = spark.createDataFrame(rows, "service string, us long, seq long")
    got = {r["seq"] for r in throttle(df, ["service"], "us", "seq", 7000, rows_per_bucket=5).collect()}
    want = set()
    for key in (None, "a"):
        last = None
        for k, us, seq in rows:
            if k == key and (last is None or us - last >= 7000):
                want.add(seq)
                last = us
    assert got == want


@pytest.mark.parametrize("apart,period,per_bucket", [(10, 30_000_000, 500), (10, 13_000, 500), (10, 700, 100), (1000, 3500, 64)])
def test_dense_traffic_of_one_key(spark, apart, period, per_bucket):
    """Rows far closer than the period: every row of a bucket is a place where the chain may enter it."""
    rng = np.random.default_rng(apart + period)
    us = np.sort(rng.integers(0, 5000 * apart, 5000))
    pdf = pd.DataFrame({"us": us, "seq": np.arange(len(us)), "key": "one"})
    got = throttle(spark.createDataFrame(pdf), ["key"], "us", "seq", period, rows_per_bucket=per_bucket)
    assert sorted(r.seq for r in got.collect()) == sorted(scan(pdf, period)[0])


def test_no_exchange_is_dealt_by_the_key_alone(spark, monkeypatch):
    """Places of a hot key are joined by (key, place), so that none of the steps brings them into one task."""
    import emberlog.operators.throttle as T

    plans, keep = [], T.stage
    monkeypatch.setattr(T, "stage", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df, name))[1])
    pdf = pd.DataFrame({"us": np.arange(4000) * 10, "seq": np.arange(4000), "key": "one"})
    out = T.throttle(spark.createDataFrame(pdf), ["key"], "us", "seq", 9000, rows_per_bucket=200)
    out.collect()
    dealt = [x.split("),")[0] for p in plans for x in p.split("hashpartitioning(")[1:]]
    by_key = [d for d in dealt if "," not in d.rsplit(", ", 1)[0]]
    # only the totals of the buckets, one row each, meet by key
    assert len(plans) > 5 and len(dealt) > 5 and len(by_key) <= 1
