"""Rollups: late rows, retried batches and interrupted merges change no total; sketches keep their bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.session import fresh_path
from emberlog.sources.rollup import RANK_ERROR, Rollup

DAY = 86_400_000_000
START = 1_718_409_600_000_000  # a midnight


@pytest.fixture(scope="module")
def rows(spark):
    """Two days of rows, a third of them of one service; a few without latency, address or instant."""
    r = np.random.default_rng(4)
    data = []
    for i in range(6000):
        us = START + int(r.integers(0, 2 * DAY))
        ms = None if i % 50 == 0 else float(np.round(r.lognormal(5, 1), 3))
        data.append((i, us, "hot" if i % 3 == 0 else f"s{i % 7}", ms, None if i % 40 == 0 else f"10.0.{i % 90}.1", i % 9 == 0, i % 11 == 0))
    df = spark.createDataFrame(data, "seq long, us long, service_name string, response_time_ms double, ip_address string, is_error boolean, is_anomaly boolean")
    return df.withColumn("timestamp", F.when(F.col("seq") != 17, F.timestamp_micros("us")))


def totals(rollup):
    got = rollup.latency(START, START + 2 * DAY, ["service_name"]).orderBy("service_name").collect()
    return [(r["service_name"], r["total"], r["min_ms"], r["max_ms"], r["avg_ms"], r["stddev_ms"], r["addresses"]) for r in got]


def test_batches_in_any_order_and_again(spark, rows):
    once = Rollup(spark, fresh_path(spark, "rollup"))
    once.append(rows, 0)
    want = totals(once)
    assert sum(w[1] for w in want) == 5999
    parts = Rollup(spark, fresh_path(spark, "rollup"))
    for k in range(5):
        parts.append(rows.filter(F.col("seq") % 5 == k), k)
        if k in (1, 3):
            parts.compact(parts.days()[0], k)
            assert parts.closed() == {parts.days()[0]: k}
            parts.append(rows.filter(F.col("seq") % 5 == 1), 1)  # comes again after the merge
    assert totals(parts) == want
    for day in parts.days():
        parts.compact(day, 4)
        parts.compact(day, 4)
    assert totals(parts) == want and parts.read().count() == once.read().count()
    assert all(not n.startswith("batch_id") for d in parts.children("open") for n in parts.children(f"open/{d}"))


def test_a_merge_without_its_end(spark, rows, monkeypatch):
    rollup = Rollup(spark, fresh_path(spark, "rollup"))
    for k in range(2):
        rollup.append(rows.filter(F.col("seq") % 2 == k), k)
    want = totals(rollup)
    monkeypatch.setattr(Rollup, "remove", lambda self, child: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        rollup.compact(rollup.days()[0], 1)
    monkeypatch.undo()
    assert totals(rollup) == want
    # later rows of the merged day stay out of a merge that does not name their batch
    rollup.append(rows.filter("seq < 100"), 5)
    rollup.compact(rollup.days()[0], 3)
    assert sum(t[1] for t in totals(rollup)) == sum(t[1] for t in want) + 99


def test_percentiles_within_the_bound(spark, rows):
    rollup = Rollup(spark, fresh_path(spark, "rollup"))
    for k in range(6):
        rollup.append(rows.filter(F.col("seq") % 6 == k), k)
    got = rollup.latency(START, START + 2 * DAY).first()
    ms = np.sort([r[0] for r in rows.filter("response_time_ms is not null and seq <> 17").select("response_time_ms").collect()])
    for name, share in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
        assert abs(np.searchsorted(ms, got[name]) / len(ms) - share) <= 2 * RANK_ERROR
    assert abs(got["addresses"] - 90) <= 5
    assert got["stddev_ms"] == pytest.approx(ms.std(), abs=0.06)


def test_timeline_reads_its_days_only(spark, rows):
    rollup = Rollup(spark, fresh_path(spark, "rollup"))
    rollup.append(rows, 0)
    end = START + 2 * DAY - 1
    got = rollup.timeline(end, hours=3).orderBy("bucket_us").collect()
    low = end - 3 * 3600 * 1_000_000
    assert len(got) == 37 and got[0]["bucket_us"] == low - low % 300_000_000
    assert sum(r["total"] for r in got) == rows.filter((F.col("us") >= got[0]["bucket_us"]) & F.col("timestamp").isNotNull()).count()
    plan = rollup.buckets(low, end)._jdf.queryExecution().toString()
    assert "log_date" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0] and "2024-06-16" in plan.split("PartitionFilters: [", 1)[1]


def test_nothing_and_nulls(spark, rows):
    rollup = Rollup(spark, fresh_path(spark, "rollup"))
    assert rollup.read().count() == 0 and rollup.days() == []
    rollup.append(rows.limit(0), 0)
    assert rollup.timeline(START, hours=1).agg(F.sum("total")).first()[0] == 0
    rollup.append(rows.filter("seq % 50 = 0").withColumn("ip_address", F.lit(None).cast("string")), 1)
    got = rollup.latency(START, START + 2 * DAY).first()
    assert got["total"] == 120 and got["p95_ms"] is None and got["avg_ms"] is None and got["addresses"] == 0
