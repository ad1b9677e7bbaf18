"""Standard scaling and the time-ordered split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.operators.ordered import ranked
from emberlog.schema import MODEL_FEATURES, TEST_FRACTION


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation of each feature, in feature order."""

    features: tuple[str, ...]
    mean: Mapping[str, float]
    std: Mapping[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {f: (F.col(f) - F.lit(self.mean[f])) / F.lit(self.std[f] or 1.0) for f in self.features}
        )


def fit_scaler(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> Scaler:
    """One aggregation over the rows to fit on (all of them, or the training part)."""
    row = df.agg(
        *[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_pop(f).alias(f"s_{f}") for f in features]
    ).first()
    return Scaler(
        tuple(features),
        {f: float(row[f"m_{f}"] or 0.0) for f in features},
        {f: float(row[f"s_{f}"] or 0.0) for f in features},
    )


def temporal_split(
    df: DataFrame, instant: str = "us", tie: str = "seq", test_fraction: float = TEST_FRACTION,
    rows_per_bucket: int | None = None, rows: int | None = None,
) -> DataFrame:
    """Add ``split``: the first ``int((1 - test_fraction) * n)`` rows in time order are ``train``, the rest ``test``.

    An existing ``rank`` is used as it is; ``rows`` saves counting them.
    """
    numbered = df if "rank" in df.columns else ranked(df, (instant, tie), rows_per_bucket=rows_per_bucket)
    last_train = int((df.count() if rows is None else rows) * (1 - test_fraction))
    return numbered.withColumn("split", F.when(F.col("rank") <= last_train, "train").otherwise("test"))
