"""Records as JSON documents: storage form, live feed, keyed messages, and the strict schema check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.schema import HISTORY_SCHEMA, INTERNAL_FIELDS

_ISO = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_PLUMBING = (*INTERNAL_FIELDS, "document", "timestamp_text", "reject_stage", "reject_reason", "log_date", "batch_id")


def document(df: DataFrame, skip: Sequence[str] = ()) -> Column:
    """JSON of all fields except the internal ones; instants as ISO-8601 text, nulls left out."""
    drop = {*_PLUMBING, *skip}
    kept = [
        c for c in df.columns
        if c not in drop and not isinstance(df.schema[c].dataType, (T.BinaryType, T.VariantType))
    ]
    return F.to_json(F.struct(*kept), _ISO)


def live_feed(df: DataFrame) -> DataFrame:
    """Add ``payload``: the document with flag, score and message type filled in (a given type is kept)."""
    flag = F.coalesce("is_anomaly", F.lit(False)) if "is_anomaly" in df.columns else F.lit(False)
    score = F.coalesce("anomaly_score", F.lit(0.0)) if "anomaly_score" in df.columns else F.lit(0.0)
    kind = F.when(flag, "anomaly").otherwise("log")
    filled = df.withColumns(
        {
            "is_anomaly": flag, "anomaly_score": score,
            "type": F.coalesce("type", kind) if "type" in df.columns else kind,
        }
    )
    return filled.withColumn("payload", document(filled))


def keyed_messages(df: DataFrame, key: str = "service_name") -> DataFrame:
    """``key, value`` rows for a topic: the service name keys the message."""
    return df.select(F.col(key).cast("string").alias("key"), document(df).alias("value"))


def publish(df: DataFrame, format: str = "kafka", **options: str) -> None:
    """Write keyed messages to a topic, or to any other batch format (for files give ``path``)."""
    keyed_messages(df).write.format(format).options(**options).mode("append").save()


def history_columns(df: DataFrame) -> list[Column]:
    """The declared history fields in order, null where ``df`` lacks one."""
    return [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in HISTORY_SCHEMA
    ]


def history_rows(df: DataFrame) -> DataFrame:
    """Project to the history schema."""
    return df.select(*history_columns(df))


def unknown_keys(document_column: str = "document") -> Column:
    """Names of the top-level keys of the raw record that the history schema does not declare."""
    keys = F.map_keys(F.col(document_column).try_cast("map<string, variant>"))
    return F.array_except(keys, F.array(*[F.lit(f.name) for f in HISTORY_SCHEMA]))


def strict_split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records that fit the history schema, and those with undeclared keys (``rejected_keys``)."""
    marked = parsed.withColumn("rejected_keys", unknown_keys())
    fits = F.coalesce(F.size("rejected_keys") == 0, F.lit(True))
    return marked.filter(fits).drop("rejected_keys"), marked.filter(~fits)
