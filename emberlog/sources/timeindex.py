"""Rows per minute of a day-partitioned table: where its newest rows begin, and where the row of any rank lies.

The index of a table has at most 1,440 rows a day, so its days (bounded by the retention) and the minutes of one day may come to the
driver. What follows is a time predicate: it prunes days, and Parquet statistics skip the rest of the day.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.schema import MICROS

MINUTE_US = 60 * MICROS
#: Rows of one bucket of a page that may be sorted at once; a larger bucket is counted in hundred parts first.
MOST = 100_000
SCHEMA = "log_date date, minute_us long, n long"
_PARTS = 100


def _bucket(width_us: int) -> Column:
    us = F.unix_micros("timestamp")
    return us - F.pmod(us, F.lit(width_us))


def minute_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per day and minute (and ``keys``); reads the time column only. Rows without an instant are not counted."""
    rows = df.filter(F.col("timestamp").isNotNull())
    day = F.col("log_date") if "log_date" in df.columns else F.to_date("timestamp")
    return rows.groupBy(day.alias("log_date"), *keys, _bucket(MINUTE_US).alias("minute_us")).agg(F.count("*").alias("n"))


def since(df: DataFrame, us: int | None) -> DataFrame:
    """Rows at or after an instant, with the bound on the day that prunes partitions."""
    if us is None:
        return df
    keep = F.col("timestamp") >= F.timestamp_micros(F.lit(us))
    if "log_date" in df.columns:
        keep = keep & (F.col("log_date") >= F.lit(_day(us)))
    return df.filter(keep)


def until(df: DataFrame, us: int) -> DataFrame:
    """Rows before an instant, with the bound on the day."""
    keep = F.col("timestamp") < F.timestamp_micros(F.lit(us))
    if "log_date" in df.columns:
        keep = keep & (F.col("log_date") <= F.lit(_day(us - 1)))
    return df.filter(keep)


def _day(us: int) -> date:
    return datetime.fromtimestamp(us // MICROS, timezone.utc).date()


@dataclass
class TimeIndex:
    """``counts`` has the rows per minute, in any number of parts."""

    counts: DataFrame
    _days: list[tuple[date, int]] | None = field(default=None, repr=False)

    def days(self) -> list[tuple[date, int]]:
        """Days with rows, newest first, and their rows: one row a day of the retention."""
        if self._days is None:
            found = self.counts.groupBy("log_date").agg(F.sum("n").alias("n")).filter("n > 0").collect()
            self._days = sorted(((r["log_date"], r["n"]) for r in found), reverse=True)
        return self._days

    def total(self) -> int:
        return sum(n for _, n in self.days())

    def locate(self, rank: int) -> tuple[int, int, int] | None:
        """The minute with the row of a 0-based rank from the newest: its start, the rows after it, its rows. None beyond the end."""
        newer = 0
        for day, n in self.days():
            if rank < newer + n:
                # at most 1,440 rows
                minutes = self.counts.filter(F.col("log_date") == F.lit(day)).groupBy("minute_us").agg(F.sum("n").alias("n")).orderBy(F.desc("minute_us")).collect()
                for r in minutes:
                    if rank < newer + r["n"]:
                        return r["minute_us"], newer, r["n"]
                    newer += r["n"]
                return None
            newer += n
        return None

    def floor(self, n: int) -> int | None:
        """An instant at or after which the ``n`` newest rows lie, and little more; None where the table has fewer."""
        found = self.locate(n - 1) if n > 0 else None
        return found and found[0]


def newest_matching(rows: DataFrame | Callable[[int | None], DataFrame], index: TimeIndex, n: int, where: Column | None = None) -> DataFrame:
    """Rows of the table that certainly hold its ``n`` newest (matching ``where``), and little more.

    The walk starts at the index's floor for ``n`` rows and goes back fourfold as long as fewer than ``n`` match, so it reads
    little more than the page needs; a probe counts no further than ``n``. What lies before the floor is older than all rows kept.
    ``rows`` may be a function that reads from an instant on, such as a deduplicated view.
    """
    read = rows if callable(rows) else lambda us: since(rows, us)
    asked = n
    while True:
        floor = index.floor(asked)
        found = read(floor)
        found = found.filter(where) if where is not None else found
        if floor is None or found.select("timestamp").limit(n).count() >= n:
            return found
        asked *= 4


def page(df: DataFrame, index: TimeIndex, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the newest-first order (ties by id), however large the offset.

    Prefix counts of the minutes tell which one the page begins in; it and the few after it are read. A minute of more than ``MOST``
    rows is counted in finer parts before it is sorted, down to one instant. The index must count exactly the rows of ``df``.
    """
    start, end = index.locate(offset), index.locate(offset + limit - 1)
    if start is None:
        return df.limit(0)
    at, newer, n = start
    width, stop = MINUTE_US, at + MINUTE_US
    while n > MOST and width > 1:
        width = max(1, width // _PARTS)
        inside = until(since(df, at), stop)
        # at most 101 rows
        parts = inside.groupBy(_bucket(width).alias("b")).agg(F.count("*").alias("n")).orderBy(F.desc("b")).collect()
        for r in parts:
            if offset < newer + r["n"]:
                at, stop, n = max(at, r["b"]), min(stop, r["b"] + width), r["n"]
                break
            newer += r["n"]
    low = min(at, end[0]) if end else None
    rows = until(since(df, low), stop)
    if end and end[0] <= at < end[0] + MINUTE_US and offset + limit <= newer + n:
        rows = until(since(df, at), stop)  # the page ends in the part it begins in
    return rows.orderBy(F.desc("timestamp"), F.asc("request_id")).offset(offset - newer).limit(limit)


def after(df: DataFrame, timestamp: datetime, request_id: str) -> DataFrame:
    """Rows behind a row of the newest-first order: the cursor of the next page, at the cost of a first page."""
    instant = F.timestamp_micros(F.lit(_micros(timestamp)))
    keep = (F.col("timestamp") < instant) | ((F.col("timestamp") == instant) & (F.col("request_id") > F.lit(request_id)))
    if "log_date" in df.columns:
        keep = keep & (F.col("log_date") <= F.to_date(instant))
    return df.filter(keep & (F.col("timestamp") <= instant))


def _micros(t: datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    gap = t - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (gap.days * 86_400 + gap.seconds) * MICROS + gap.microseconds
