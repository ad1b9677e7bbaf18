"""Sliding-window alerts over micro-batches.

The anomaly count is global and the cooldown depends on earlier alerts, which as keyed state would put the whole
stream into one task. Instead each batch runs the parallel batch operators over its anomalies and the carried
last 60 seconds, and passes the last alert per service on to the next batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.alerts import anomaly_counts, build_alerts
from emberlog.operators.throttle import throttle
from emberlog.schema import ALERT_COOLDOWN_S, ALERT_HIGH, ALERT_WINDOW_S, MICROS, NOTICE_PERIOD_S
from emberlog.session import stage
from emberlog.sources.versions import VersionedTable


class AlertState:
    """Carried between batches: recent anomaly instants, the last alert per service, and the event clock."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.recent = VersionedTable(spark, f"{path}/recent", "us long, service_name string, tie string")
        self.fired = VersionedTable(spark, f"{path}/fired", "service_name string, last_us long")
        self.clock = VersionedTable(spark, f"{path}/clock", "clock_us long, late_rows long")


def alert_batch(
    scored: DataFrame, batch_id: int, state: AlertState, lateness_s: int = 60, scope: str = "global",
    tie: str = "arrival", rows_per_bucket: int | None = None,
) -> DataFrame:
    """Alert records fired by one batch.

    ``tie`` is a number that orders rows of one instant and is unique in the batch. Rows behind the clock by at most ``lateness_s`` count as arriving now; older ones are late, counted and left out.
    """
    before = state.clock.read(before=batch_id).first()
    clock, late_so_far = (before["clock_us"], before["late_rows"]) if before else (None, 0)
    fresh = scored.filter("is_anomaly").withColumn("event_us", F.unix_micros("timestamp"))
    if clock is None:
        timely = fresh.withColumn("us", F.col("event_us"))
    else:
        timely = fresh.filter(F.col("event_us") >= clock - lateness_s * MICROS).withColumn(
            "us", F.greatest(F.col("event_us"), F.lit(clock))
        )
    # Carried rows come before fresh ones of the same instant.
    ordered = F.format_string("1|%020d", F.col(tie).cast("bigint"))
    timely = stage(timely.withColumns({"tie": ordered, "fresh": F.lit(True)}), "anomalies")
    carried = state.recent.read(before=batch_id)
    both = timely.unionByName(carried, allowMissingColumns=True)
    counted = anomaly_counts(both, "us", "tie", scope, rows_per_bucket)
    over = stage(counted.filter(F.col("fresh") & (F.col("anomaly_count") > ALERT_HIGH)), "over")
    fired_before = state.fired.read(before=batch_id)
    passed = stage(
        throttle(over, ["service_name"], "us", "tie", ALERT_COOLDOWN_S * MICROS, fired_before, rows_per_bucket), "fired"
    )

    totals = timely.agg(F.max("us").alias("top"), F.count("*").alias("n")).first()
    late = 0 if clock is None else fresh.count() - totals["n"]
    top = max(x for x in (clock, totals["top"], 0) if x is not None)
    earliest = top - ALERT_WINDOW_S * MICROS
    state.recent.write(
        both.filter(F.col("us") >= earliest).select(
            "us", "service_name", F.concat(F.lit("0|"), F.substring("tie", 3, 20)).alias("tie")
        ),
        batch_id,
    )
    latest = fired_before.unionByName(passed.select("service_name", F.col("us").alias("last_us")))
    state.fired.write(latest.groupBy("service_name").agg(F.max("last_us").alias("last_us")), batch_id)
    clock_row = [(int(top), int(late_so_far + late))]
    state.clock.write(scored.sparkSession.createDataFrame(clock_row, state.clock.schema), batch_id)
    return build_alerts(passed)


def notice_state(spark: SparkSession, path: str) -> VersionedTable:
    """Carried between batches: the last notice per service and level."""
    return VersionedTable(spark, path, "service_name string, log_level string, last_us long")


def notice_batch(
    scored: DataFrame, batch_id: int, state: VersionedTable, tie: str = "arrival", rows_per_bucket: int | None = None
) -> DataFrame:
    """Anomaly rows of one batch to show, at most one per five seconds for each service and level.

    A row behind the last notice of its key falls into that notice's period.
    """
    keys = ["service_name", "log_level"]
    before = state.read(before=batch_id)
    # One row per service and level; a row that precedes its key's last notice cannot pass.
    fresh = scored.filter("is_anomaly").withColumn("us", F.unix_micros("timestamp")).join(before, keys, "left")
    fresh = fresh.filter(F.col("last_us").isNull() | (F.col("us") >= F.col("last_us"))).drop("last_us")
    passed = stage(throttle(fresh, keys, "us", tie, NOTICE_PERIOD_S * MICROS, before, rows_per_bucket), "notices")
    latest = before.unionByName(passed.select(*keys, F.col("us").alias("last_us")))
    state.write(latest.groupBy(*keys).agg(F.max("last_us").alias("last_us")), batch_id)
    return passed
