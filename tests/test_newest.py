"""The time index: walks to the newest rows, and pages of any depth."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.operators.search import newest_first
from emberlog.sources import timeindex
from emberlog.sources.history import History
from emberlog.sources.timeindex import TimeIndex, after, minute_counts, newest_matching, page, since

START = datetime(2024, 3, 1, 6, 0)
SCHEMA = "timestamp timestamp, request_id string, log_level string, service_name string, status_code int, consumed_at timestamp"


def rows(spark, spec, status=200, consumed=0):
    """Records of ``(day, number)`` pairs: that many, a second apart."""
    out = []
    for day, n in spec:
        out += [(START + timedelta(days=day, seconds=i), f"d{day}-{i}", "ERROR" if i % 50 == 0 else "INFO", "s", status, START + timedelta(days=99, seconds=consumed)) for i in range(n)]
    return spark.createDataFrame(out, SCHEMA)


def days_of(df):
    return sorted({r[0] for r in df.select("log_date").distinct().collect()})


@pytest.fixture(scope="module")
def sixty(spark, tmp_path_factory):
    history = History(spark, str(tmp_path_factory.mktemp("sixty")))
    history.append(rows(spark, [(d, 150) for d in range(60)]), 0)
    return history


def test_a_page_over_sixty_days_reads_one(spark, sixty):
    found = sixty.newest(100)
    assert days_of(found) == [date(2024, 4, 29)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "log_date#" in plan.split("PartitionFilters")[1][:200] and "GreaterThanOrEqual(timestamp" in plan
    want = newest_first(sixty.view(), 100).collect()
    assert newest_first(found, 100).collect() == want and sixty.newest(80).count() == 90
    assert len(days_of(sixty.newest(151))) == 2


def test_a_predicate_walks_back_as_far_as_it_must(sixty):
    found = sixty.newest(10, F.col("log_level") == "ERROR")
    assert 4 <= len(days_of(found)) <= 16 and found.count() >= 10
    assert sixty.newest(5, F.col("log_level") == "none").count() == 0
    assert sixty.newest(10**6).count() == 9000


def test_empty_days_replays_and_missing_counts(spark, tmp_path):
    history = History(spark, str(tmp_path))
    assert history.newest(5).count() == 0
    history.append(rows(spark, [(0, 30), (40, 3), (80, 2)]), 0)
    history.append(rows(spark, [(80, 2)], status=500, consumed=9), 1)  # replays: four stored rows, two records
    assert days_of(history.newest(2)) == [date(2024, 5, 20)] and days_of(history.newest(4))[-2:] == [date(2024, 4, 10), date(2024, 5, 20)] and history.index().total() == 37
    got = newest_first(history.newest(4), 4).collect()
    assert [r.status_code for r in got] == [500, 500, 200, 200]
    # a writer that stopped before it counted, and counts whose batch is gone
    history._delete(f"{tmp_path}/_index/log_date=2024-05-20/batch_id=1")
    history._delete(f"{tmp_path}/log_date=2024-04-10")
    assert history.index().total() == 34
    for day in history.days():
        history.compact(day)
    assert history.index().total() == 32 and history.index().total() == history.stored().count()
    history.append(rows(spark, []), 5)
    history.purge(START + timedelta(days=81), 5)
    assert history.index().days() == [(date(2024, 5, 20), 2)]


@pytest.mark.parametrize("most", [100_000, 40, 1])
def test_pages_are_those_of_a_full_sort(spark, monkeypatch, most):
    monkeypatch.setattr(timeindex, "MOST", most)
    rng = random.Random(7)
    instants = [START + timedelta(minutes=rng.choice([0, 0, 0, 1, 5, 3000]), microseconds=rng.choice([0, 1, 17, 900_000, 59_999_999])) for _ in range(600)]
    df = spark.createDataFrame([(t, f"r{i:03}") for i, t in enumerate(instants)], "timestamp timestamp, request_id string").withColumn("log_date", F.to_date("timestamp")).cache()
    index = TimeIndex(minute_counts(df))
    want = [r.request_id for r in df.orderBy(F.desc("timestamp"), "request_id").collect()]
    for offset, limit in ((0, 7), (100, 50), (333, 120), (599, 10), (580, 20), (600, 5), (0, 600)):
        got = [r.request_id for r in page(df, index, offset, limit).orderBy(F.desc("timestamp"), "request_id").collect()]
        assert got == want[offset : offset + limit]


def test_a_deep_page_reads_one_bucket(spark, sixty):
    df = sixty.stored()
    index = TimeIndex(minute_counts(df))
    plan = page(df, index, 7000, 20)
    assert {r.timestamp.date() for r in plan.collect()} == {date(2024, 3, 14)}
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-03-14" in text and "timestamp" in text
    low, newer, n = index.locate(7000)
    assert n <= 60 and newer <= 7000 < newer + n


def test_cursors_continue_a_page(spark, sixty):
    df = sixty.stored()
    first = newest_first(df, 30).collect()
    rest = newest_first(after(df, first[-1].timestamp, first[-1].request_id), 30).collect()
    assert first + rest == newest_first(df, 60).collect()
    index = TimeIndex(minute_counts(df))
    assert newest_first(newest_matching(df, index, 60), 60).collect() == first + rest
    assert since(df, None) is df and index.floor(0) is None and index.locate(9000) is None
