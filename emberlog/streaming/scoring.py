"""Serving features and scores per micro-batch, continuing the sequence of the batches before it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.features import base_features, serving_from_rank
from emberlog.operators.joins import sized
from emberlog.operators.models.evaluation import score_or_cold
from emberlog.operators.ordered import running_totals, split_order
from emberlog.schema import MODEL_FEATURES, WARM_UP_ROWS
from emberlog.session import stage
from emberlog.sources.versions import RunningSums, VersionedTable

_TAIL = "rank long, rt double, is_http_error int"


class ScoringState:
    """Carried between batches: the last 99 rows, the number of rows so far, and requests per address."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.tail = VersionedTable(spark, f"{path}/tail", _TAIL)
        self.addresses = RunningSums(spark, f"{path}/addresses", "ip_address")


def serving_batch(
    batch: DataFrame, batch_id: int, state: ScoringState, stats: Mapping[str, float] | None = None,
    instant: str = "us", tie: str = "arrival",
) -> DataFrame:
    """Serving features of one batch. All steps are the parallel batch operators; the state read is small."""
    base = stage(base_features(batch), "scoring")
    before = state.tail.read(before=batch_id)
    offset = before.agg(F.max("rank")).first()[0] or 0
    splits = split_order(base, (instant, tie))
    one = F.lit(1).cast("bigint")
    numbered = running_totals(base, (instant, tie), {"rank": one}, splits=splits)
    numbered = numbered.withColumn("rank", F.col("rank") + F.lit(offset))
    counted = running_totals(numbered, (instant, tie), {"in_batch": one}, ("ip_address",), splits=splits)
    per_ip = base.groupBy("ip_address").agg(F.count("*").alias("n"))
    seen = state.addresses.read(before=batch_id).join(per_ip.select("ip_address"), "ip_address", "left_semi")
    seen = sized(seen.withColumnRenamed("n", "earlier"), name="addresses")
    counted = counted.join(seen, "ip_address", "left").withColumn(
        "ip_n", F.col("in_batch") + F.coalesce("earlier", F.lit(0))
    ).drop("in_batch", "earlier")
    counted = stage(counted, "numbered")
    with_tail = counted.unionByName(before, allowMissingColumns=True)
    out = serving_from_rank(with_tail, stats or {}).filter(F.col("rank") > offset).drop("ip_n")
    last = offset + counted.count()
    kept = with_tail.filter(F.col("rank") > last - (WARM_UP_ROWS - 1))
    state.tail.write(kept.select("rank", "rt", "is_http_error").coalesce(1), batch_id)
    state.addresses.add(per_ip, batch_id)
    return out


def score_batch(
    batch: DataFrame, batch_id: int, state: ScoringState, model=None, scaler=None,
    stats: Mapping[str, float] | None = None, mode: str | None = None,
) -> DataFrame:
    """The rows of a batch with ``is_anomaly`` and ``anomaly_score`` added; ``arrival`` identifies a row."""
    if model is None:
        return score_or_cold(batch, None)
    features = serving_batch(batch, batch_id, state, stats)
    narrow = features.select("arrival", *MODEL_FEATURES)
    decided = score_or_cold(scaler.transform(narrow) if scaler else narrow, model, mode)
    scores = decided.select("arrival", "is_anomaly", F.round("anomaly_score", 6).alias("anomaly_score"))
    return batch.join(scores, "arrival")
