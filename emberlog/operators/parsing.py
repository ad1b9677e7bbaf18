"""Raw bytes to validated, enriched log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import scalar as X
from emberlog.schema import ALERT_SCHEMA, ALERT_WINDOW_S, API_FIELDS, LEVELS, OPTIONAL_FIELDS, REQUIRED_FIELDS

_DOC = "document"


def _computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters must not recompute.

    A filter on a plain projection is pushed below it with every reference replaced by its expression, which
    would parse the JSON again for each check. A generated row is evaluated once and filtered afterwards.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``document``: the JSON value, null when the bytes are not UTF-8 JSON (or are JSON ``null``)."""
    parsed = F.try_parse_json(F.try_validate_utf8(F.col(value).cast("string")))
    out = _computed(df, {_DOC: parsed})
    return out.withColumn(_DOC, F.when(~F.is_variant_null(F.col(_DOC)), F.col(_DOC)))


def _field(name: str) -> Column:
    return F.try_variant_get(F.col(_DOC), f"$.{name}", "variant")


def _first_failure() -> Column:
    """The first failing check: per field presence then type in declared order, then the ranges."""
    checks = []
    for name, kind in REQUIRED_FIELDS:
        found, shape = F.col(f"__f_{name}"), F.col(f"__t_{name}")
        checks.append(F.when(found.isNull(), F.lit(f"missing:{name}")))
        if kind == "string":
            good = shape == "STRING"
        elif name == "response_time_ms":
            number = (shape == "BIGINT") | (shape == "DOUBLE") | shape.startswith("DECIMAL")
            good = number & F.col("__rt").isNotNull()
        else:
            good = (shape == "BIGINT") & F.col("__sc").isNotNull()
        checks.append(F.when(~good, F.lit(f"type:{name}")))
    level = F.try_variant_get(F.col(_DOC), "$.log_level", "string")
    text = F.try_variant_get(F.col(_DOC), "$.timestamp", "string")
    checks += [
        F.when(~level.isin(*LEVELS), F.lit("range:log_level")),
        F.when(F.col("__rt") < 0, F.lit("range:response_time_ms")),
        F.when(~F.col("__sc").between(100, 599), F.lit("range:status_code")),
        F.when(~text.rlike(r"\S"), F.lit("range:timestamp")),
    ]
    return F.coalesce(*checks)


def validate(df: DataFrame) -> DataFrame:
    """Add ``reject_stage`` (decode, validate, timestamp or null), ``reject_reason`` and the typed fields.

    The checks are held in a generated row; the typed fields are plain columns of the document, so that only those asked for are read.
    """
    shaped = _computed(df, {f"__f_{n}": _field(n) for n, _ in REQUIRED_FIELDS})
    shaped = _computed(
        shaped,
        {
            **{f"__t_{n}": F.schema_of_variant(F.col(f"__f_{n}")) for n, _ in REQUIRED_FIELDS},
            "__rt": F.try_variant_get(F.col(_DOC), "$.response_time_ms", "int"),
            "__sc": F.try_variant_get(F.col(_DOC), "$.status_code", "int"),
        },
    )
    text = F.try_variant_get(F.col(_DOC), "$.timestamp", "string")
    typed = {n: F.try_variant_get(F.col(_DOC), f"$.{n}", t) for n, t in (*REQUIRED_FIELDS, *OPTIONAL_FIELDS) if n != "timestamp"}
    failure = F.when(F.col(_DOC).isNotNull(), _first_failure())
    out = _computed(shaped, {"__failure": failure, "timestamp": X.parse_iso(text)})
    out = out.drop(*[c for c in out.columns if c.startswith("__") and c != "__failure"])
    out = out.withColumns({**typed, "timestamp_text": text})
    stage = (
        F.when(F.col(_DOC).isNull(), F.lit("decode"))
        .when(F.col("__failure").isNotNull(), F.lit("validate"))
        .when(F.col("timestamp").isNull(), F.lit("timestamp"))
    )
    reason = (
        F.when(F.col(_DOC).isNull(), F.lit("decode"))
        .when(F.col("__failure").isNotNull(), F.col("__failure"))
        .when(F.col("timestamp").isNull(), F.lit("timestamp"))
    )
    return out.withColumns({"reject_stage": stage, "reject_reason": reason}).drop("__failure")


def enrich(df: DataFrame) -> DataFrame:
    """Add the derived fields to rows with a parsed ``timestamp``."""
    ts, status = F.col("timestamp"), F.col("status_code")
    return df.withColumns(
        {
            "level_int": X.level_int(F.col("log_level")),
            "is_error": X.is_error(F.col("log_level")),
            "is_slow": X.is_slow(F.col("response_time_ms")),
            "status_class": F.expr("CAST(status_code div 100 AS INT)"),
            "is_server_error": status >= 500,
            "hour_of_day": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "endpoint_depth": X.count_char(F.coalesce("endpoint", F.lit("")), "/"),
            "consumed_at": F.current_timestamp(),
        }
    )


def numeric_features(df: DataFrame) -> DataFrame:
    """Add ``features``: the ten numeric fields of an enriched record as doubles."""
    names = (
        "response_time_ms", "status_code", "level_int", "status_class", "is_error", "is_slow",
        "is_server_error", "hour_of_day", "day_of_week", "endpoint_depth",
    )
    return df.withColumn(
        "features", F.struct(*[F.col(n).cast("int").cast("double").alias(n) for n in names])
    )


def parse_logs(df: DataFrame, value: str = "value") -> DataFrame:
    """All stages at once: every input row, with ``reject_stage`` null on the valid ones."""
    return numeric_features(enrich(validate(decode(df, value))))


def valid_logs(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_stage").isNull()).drop("reject_stage", "reject_reason")


def dead_letters(parsed: DataFrame, value: str = "value") -> DataFrame:
    return parsed.filter(F.col("reject_stage").isNotNull()).select(value, "reject_stage", "reject_reason")


def pipeline_counters(parsed: DataFrame) -> DataFrame:
    """Received, processed and skipped rows by stage."""
    stage = F.col("reject_stage")
    return parsed.agg(
        F.count("*").alias("received"),
        F.count_if(stage.isNull()).alias("processed"),
        F.count_if(stage == "decode").alias("skipped_decode"),
        F.count_if(stage == "validate").alias("skipped_validate"),
        F.count_if(stage == "timestamp").alias("skipped_timestamp"),
    )


def api_projection(df: DataFrame) -> DataFrame:
    """The 16 published fields, null where the table lacks one."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in API_FIELDS])


def sample_log() -> Column:
    """The eight fields an alert shows of the row that fired it."""
    return F.struct(
        X.iso_text(F.col("timestamp")).alias("timestamp"),
        F.coalesce("service_name", F.lit("")).alias("service_name"),
        F.coalesce("log_level", F.lit("")).alias("log_level"),
        F.coalesce("endpoint", F.lit("")).alias("endpoint"),
        F.coalesce("response_time_ms", F.lit(0)).cast("int").alias("response_time_ms"),
        F.coalesce("status_code", F.lit(0)).cast("int").alias("status_code"),
        F.round(F.coalesce("anomaly_score", F.lit(0.0)), 4).alias("anomaly_score"),
        F.substring(F.coalesce("message", F.lit("")), 1, 120).alias("message"),
    )


def parse_alerts(df: DataFrame, value: str = "value") -> DataFrame:
    """Alert JSON to typed rows: corrupt entries are skipped, absent fields take their defaults."""
    doc = F.try_parse_json(F.col(value))
    root = df.select(doc.alias("d")).filter(F.schema_of_variant("d").startswith("OBJECT"))

    def get(path: str, kind: str) -> Column:
        return F.try_variant_get(F.col("d"), f"$.{path}", kind)

    # The defaults of absent alert fields.
    defaults = {
        "alert_id": "unknown", "timestamp": "", "alert_type": "", "severity": "HIGH", "anomaly_count": 0,
        "window_seconds": ALERT_WINDOW_S, "rate_per_min": 0.0, "threshold_used": 10,
    }
    ready, cols = [], []
    for field in ALERT_SCHEMA.fields:
        if field.name == "sample_log":
            parts = [get(f"sample_log.{f.name}", f.dataType.simpleString()).alias(f.name) for f in field.dataType.fields]
            cols.append(F.struct(*parts).alias("sample_log"))
            continue
        got = get(field.name, field.dataType.simpleString())
        present = get(field.name, "variant").isNotNull()
        ready.append(~present | got.isNotNull())
        cols.append(F.coalesce(got, F.lit(defaults[field.name])).alias(field.name))
    condition = ready[0]
    for more in ready[1:]:
        condition = condition & more
    return root.filter(condition).select(*cols)


def parse_recent(df: DataFrame, value: str = "value") -> DataFrame:
    """Stored log JSON to the published fields: corrupt JSON and unknown levels are skipped."""
    kinds = {"response_time_ms": "int", "status_code": "int", "is_error": "boolean", "is_slow": "boolean",
             "level_int": "int", "hour_of_day": "int"}
    root = df.select(F.try_parse_json(F.col(value)).alias("d")).filter(F.schema_of_variant("d").startswith("OBJECT"))
    out = root.select(*[F.try_variant_get(F.col("d"), f"$.{c}", kinds.get(c, "string")).alias(c) for c in API_FIELDS])
    return out.filter(F.col("log_level").isNull() | F.col("log_level").isin(*LEVELS))
